"""Registered queries over the given tables, each with its check in SQL where SQL can state it."""
