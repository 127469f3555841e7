"""Meter-telemetry analytics on Spark: load, clean, report and check meter readings."""

__version__ = "0.1.0"
