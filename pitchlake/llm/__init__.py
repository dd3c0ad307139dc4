"""Operators for large text corpora: sharding, identification, deduplication, mixing, encoding."""
