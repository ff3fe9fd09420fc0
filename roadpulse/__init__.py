"""Floating-car-data analytics expressed as Spark DataFrame and streaming jobs."""

from roadpulse.schema import EVENT_COLUMNS, EVENT_SCHEMA, GRID, Box, Grid

__all__ = ["EVENT_COLUMNS", "EVENT_SCHEMA", "GRID", "Box", "Grid"]
