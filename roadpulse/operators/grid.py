"""Placing events on the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import grid as grid_fn
from roadpulse.schema import GRID, Grid


def with_cell(events: DataFrame, grid: Grid = GRID) -> DataFrame:
    """Add ``cellid`` and ``in_bbox``; points outside the box are in cell 0."""
    lon, lat = F.col("lon"), F.col("lat")
    return events.withColumns(
        {
            "cellid": grid_fn.cell_id(lon, lat, grid),
            "in_bbox": F.coalesce(grid_fn.inside(lon, lat, grid.box), F.lit(False)),
        }
    )


def with_cell_centre(cells: DataFrame, grid: Grid = GRID) -> DataFrame:
    """Add the centre of ``cellid`` as ``lat``, ``lon``. Meant for aggregated rows."""
    cell = F.col("cellid")
    return cells.withColumns(
        {"lat": grid_fn.centre_lat(cell, grid), "lon": grid_fn.centre_lon(cell, grid)}
    )
