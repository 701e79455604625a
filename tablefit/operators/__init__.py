"""Operators: checks, splits, estimators, search, selection, scoring, calibration."""
