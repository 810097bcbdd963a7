"""Registered queries over the given tables, and what they are checked against."""
