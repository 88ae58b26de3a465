"""Compositions of operators; each runs on bounded tables and on streams."""
