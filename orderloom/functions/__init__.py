"""Column functions; all built in, no Python runs per row."""
