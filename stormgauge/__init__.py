"""Interval-event and sensor-reading analytics written as PySpark DataFrame functions."""

__version__ = "0.1.0"
