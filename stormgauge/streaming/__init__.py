"""Windowed KPIs over readings, and the runners that stream them."""
