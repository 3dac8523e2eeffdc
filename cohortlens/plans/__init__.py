"""Queries over the given tables, their SQL twins, and whole jobs."""
