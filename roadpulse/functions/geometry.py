"""Planar point-to-segment distance in degrees of latitude."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: cos(40.6 degrees); one degree of longitude in degrees of latitude.
LON_SCALE = 0.7592713073


def segment_shape(x1: Column, y1: Column, x2: Column, y2: Column) -> list[Column]:
    """What the distance needs of a segment: start, direction, squared length.

    A segment of length 0 gets the length 1: its direction is zero, so the nearest
    point is its start either way.
    """
    dx, dy = (x2 - x1) * LON_SCALE, y2 - y1
    squared = dx * dx + dy * dy
    return [
        x1.alias("x1"),
        y1.alias("y1"),
        dx.alias("dx"),
        dy.alias("dy"),
        F.when(squared == 0.0, F.lit(1.0)).otherwise(squared).alias("len2"),
    ]


def along_segment(lon: Column, lat: Column, shape: Column) -> Column:
    """First half of the distance: offset from the start, and how far along the nearest
    point lies (0 to 1). Keeps the id, for use on packed candidates."""
    px, py = (lon - shape["x1"]) * LON_SCALE, lat - shape["y1"]
    along = (px * shape["dx"] + py * shape["dy"]) / shape["len2"]
    return F.struct(
        px.alias("px"),
        py.alias("py"),
        F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0)).alias("along"),
        shape["dx"].alias("dx"),
        shape["dy"].alias("dy"),
        shape["segment_id"].alias("segment_id"),
    )


def offset_squared(step: Column) -> Column:
    """Second half of the distance, from an ``along_segment`` struct."""
    ex = step["px"] - step["along"] * step["dx"]
    ey = step["py"] - step["along"] * step["dy"]
    return ex * ex + ey * ey


def squared_distance(lon: Column, lat: Column, shape: Column) -> Column:
    """Squared distance of a point to a segment given by a ``segment_shape`` struct."""
    px, py = (lon - shape["x1"]) * LON_SCALE, lat - shape["y1"]
    along = (px * shape["dx"] + py * shape["dy"]) / shape["len2"]
    along = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    ex, ey = px - along * shape["dx"], py - along * shape["dy"]
    return ex * ex + ey * ey
