"""Continuous form of the incremental sync."""
