"""Readers, writers and layer naming."""
