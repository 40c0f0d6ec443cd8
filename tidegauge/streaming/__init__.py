"""Arrival of files and late corrections as streams."""
