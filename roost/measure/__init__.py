"""Timing workloads and reporting the result."""
