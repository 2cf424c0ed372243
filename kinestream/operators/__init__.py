"""Joins, windows, aggregates and contracts over streams."""
