"""Spark batch engine for seasonal football snapshots."""
