"""Registered queries and the SQL each one is cross-checked with."""
