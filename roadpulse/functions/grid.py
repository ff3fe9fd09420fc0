"""Grid arithmetic: bounding box, cell of a point, centre of a cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.schema import Box, Grid


def inside(lon: Column, lat: Column, box: Box) -> Column:
    """Strictly inside the box. Plain comparisons, so a Parquet scan can use them."""
    return (lon > box.west) & (lon < box.east) & (lat > box.south) & (lat < box.north)


def cell_id(lon: Column, lat: Column, grid: Grid) -> Column:
    """Cell of a point, 0 outside the box (also for a missing or NaN coordinate).

    Grid lines are rounded doubles, so one division can land a point next to a line
    in the wrong cell. The division gives a start one cell early; the point then
    moves on past each of the next two far lines it does not lie before. Rows own
    their northern line, columns their western one.
    """
    box = grid.box

    row = _start((F.lit(box.north) - lat) / grid.row_height, grid.rows)
    row = row + _passed(lat <= _south_line(row, grid)) + _passed(lat <= _south_line(row + 1, grid))

    col = _start((lon - F.lit(box.west)) / grid.col_width, grid.cols)
    col = col + _passed(lon >= _east_line(col, grid)) + _passed(lon >= _east_line(col + 1, grid))

    number = F.least(row, F.lit(grid.rows - 1)) * grid.cols + F.least(col, F.lit(grid.cols - 1)) + 1
    return F.when(inside(lon, lat, box), number).otherwise(F.lit(0)).cast("int")


def centre_lat(cell: Column, grid: Grid) -> Column:
    """Latitude of the middle of a cell; cell 0 gets the row north of the grid."""
    row = F.ceil(cell / grid.cols)
    return F.lit(grid.box.north) - (row - F.lit(0.5)) * grid.row_height


def centre_lon(cell: Column, grid: Grid) -> Column:
    """Longitude of the middle of a cell; cell 0 gets the last column."""
    rest = cell % grid.cols
    col = F.when(rest == 0, F.lit(grid.cols)).otherwise(rest)
    return F.lit(grid.box.west) + (col - F.lit(0.5)) * grid.col_width


def _start(steps: Column, count: int) -> Column:
    return F.greatest(F.least(F.floor(steps).cast("int") - 1, F.lit(count - 1)), F.lit(0))


def _passed(condition: Column) -> Column:
    return condition.cast("int")


def _south_line(row: Column, grid: Grid) -> Column:
    return (F.lit(grid.box.north) - F.lit(grid.row_height) * row) - grid.row_height


def _east_line(col: Column, grid: Grid) -> Column:
    return (F.lit(grid.box.west) + F.lit(grid.col_width) * col) + grid.col_width
