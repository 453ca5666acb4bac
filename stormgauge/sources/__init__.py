"""Readers for raw event files, the cleaned table, airports and readings."""
