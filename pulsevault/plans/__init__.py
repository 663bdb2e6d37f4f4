"""Composed plans: the layered lakehouse and the query registry."""
