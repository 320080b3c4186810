"""Operators of a training-data pipeline: archives, deduplication, mixing, scoring, search and tokens."""
