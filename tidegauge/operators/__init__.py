"""Marts, checks, facts, forecasts, indicators, text grounding, calibration and audits as DataFrame functions."""
