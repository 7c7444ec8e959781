"""Composed work: dimension and fact loads, the full refresh, the reports."""
