"""Incremental runs over landed days."""
