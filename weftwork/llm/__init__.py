"""Operators of a training-data pipeline: extraction, selection, deduplication, packing, token files."""
