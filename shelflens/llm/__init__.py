"""Operators for preparing training text: search, quality, deduplication, mixing, packing."""
