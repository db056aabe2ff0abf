"""Whole jobs composed of operators, and the query catalogue."""
