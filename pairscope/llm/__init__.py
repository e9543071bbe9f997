"""Operators of a training-data pipeline: extraction, filtering, deduplication, mixing, sharding."""
