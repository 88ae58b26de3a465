"""Maintenance of stored tables."""
