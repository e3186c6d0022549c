"""Operators for large text collections: scoring, deduplication, indexing, encoding, filtering."""
