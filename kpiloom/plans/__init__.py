"""Composed plans: the registry of queries and the end-to-end mart build."""
