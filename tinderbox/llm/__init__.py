"""Operators for training-data pipelines: quality, dedup, privacy, search, packing and mixing."""
