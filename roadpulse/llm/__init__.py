"""Operators of a training-data pipeline: filters, deduplication, extraction, counting, packing."""
