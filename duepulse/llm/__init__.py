"""Operators for preparing training data: scoring, cleaning, deduplication, mixing, packing."""
