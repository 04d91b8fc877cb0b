"""Pipelines over files as they arrive."""
