"""Operators for preparing training data: search, counting, mixing, cleaning and deduplication of texts."""
