"""Runnable jobs: raw to clean, clean to curated tables, feed to live tables."""
