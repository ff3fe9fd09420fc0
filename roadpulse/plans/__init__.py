"""Whole jobs, from source to sink."""
