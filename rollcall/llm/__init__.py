"""Operators of a training-data pipeline: filtering, deduplication, privacy, tokens, packing."""
