"""Micro-batch runs over the same functions as batch jobs."""
