"""Streaming queries over the same operators as the bounded tables."""
