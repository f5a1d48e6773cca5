"""Operators of a training-data pipeline: counting, mixing, scoring, deduplication, packing and extraction."""
