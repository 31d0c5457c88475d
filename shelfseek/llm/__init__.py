"""Operators for preparing training data: screening, scoring, deduplication, mixing and sharding of texts."""
