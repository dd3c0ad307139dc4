"""Readers: raw snapshot text, typed JSON records and published tables."""
