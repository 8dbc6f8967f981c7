"""Registered queries over the given tables, and SQL that must return the same rows."""
