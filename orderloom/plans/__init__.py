"""Whole jobs composed of operators, and the queries registered for checking."""
