"""Stateful stream operators."""
