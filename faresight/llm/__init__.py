"""Operators of a training-data pipeline (deduplication, packing, scoring,
archives, search, mixing). Nothing else in the library imports this package."""
