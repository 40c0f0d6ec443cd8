"""Scans and sinks of the feeds, and the tables at hand read as feeds."""
