"""Readers of registry files, dimensions and survey tables."""
