"""Readers of tables, files and landed captures."""
