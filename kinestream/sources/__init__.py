"""Readers and writers of recording formats."""
