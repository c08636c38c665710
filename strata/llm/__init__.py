"""Operators of a training-data pipeline: packing, search, extraction, mixing, deduplication."""
