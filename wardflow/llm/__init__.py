"""Operators of a training-data pipeline: text deduplication, tokenising, filtering, mixing, search."""
