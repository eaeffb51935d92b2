"""Queries, marts and pipelines."""
