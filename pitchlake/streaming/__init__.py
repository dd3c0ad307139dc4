"""Snapshots as they arrive."""
