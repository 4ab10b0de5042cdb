"""Operators for preparing training data: counting, filtering, deduplication, mixing, packing."""
