"""Accessibility analytics on Spark: travel times, coverage and map exports."""
