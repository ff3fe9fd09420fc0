import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators.clean import filter_bbox, in_bbox
from roadpulse.operators.grid import with_cell, with_cell_centre
from roadpulse.schema import GRID, Box, Grid


def scan_cell(lon, lat, grid=GRID):
    """Cell of a point by trying one grid line after the other."""
    box, dy, dx = grid.box, grid.row_height, grid.col_width
    if not (box.west < lon < box.east and box.south < lat < box.north):
        return 0
    rows = (i for i in range(grid.rows) if box.north - dy * i >= lat > (box.north - dy * i) - dy)
    cols = (
        i for i in range(grid.cols) if box.west + dx * i <= lon < (box.west + dx * i) + dx
    )
    row, col = next(rows, None), next(cols, None)
    if row is None or col is None:
        return None  # rounding left a gap of one double between two cells
    return row * grid.cols + col + 1


def cells_of(spark, points, grid=GRID):
    rows = [(i, float(lon), float(lat)) for i, (lon, lat) in enumerate(points)]
    df = spark.createDataFrame(rows, "i int, lon double, lat double")
    return [r.cellid for r in with_cell(df, grid).orderBy("i").collect()]


def test_known_points(spark):
    points = [(22.948426, 40.626444), (22.00, 40.80), (22.90, 40.69)]
    assert cells_of(spark, points)[:2] == [3660, 0]
    df = spark.createDataFrame(points, "lon double, lat double")
    assert [r.in_bbox for r in in_bbox(df).collect()] == [True, False, True]
    assert filter_bbox(df).count() == 2


@pytest.mark.parametrize(
    "grid", [GRID, Grid(GRID.box, 4, 4), Grid(Box(-3.0, 1.0, 50.0, 53.0), 30, 70)]
)
def test_every_line_and_its_neighbours(spark, grid):
    lats, lons = [], []
    for i in range(grid.rows + 1):
        line = grid.box.north - grid.row_height * i
        lats += [line, math.nextafter(line, 90), math.nextafter(line, -90), round(line, 5)]
    for i in range(grid.cols + 1):
        line = grid.box.west + grid.col_width * i
        lons += [line, math.nextafter(line, 180), math.nextafter(line, -180), round(line, 5)]
    size = max(len(lats), len(lons))
    points = [(lons[i % len(lons)], lats[i % len(lats)]) for i in range(size)]
    points += [(lons[(7 * i) % len(lons)], lats[(3 * i) % len(lats)]) for i in range(5 * size)]
    scanned = [scan_cell(*p, grid) for p in points]
    got = cells_of(spark, points, grid)
    assert all(a == b for a, b in zip(got, scanned) if b is not None)
    assert all(1 <= a <= grid.rows * grid.cols for a, b in zip(got, scanned) if b is None)
    assert grid is not GRID or None not in scanned


def test_five_decimal_lattice(spark):
    lats = [round(40.5 + i / 1e5, 5) for i in range(0, 20001)]
    points = [(round(22.8 + (i * 37 % 25001) / 1e5, 5), lat) for i, lat in enumerate(lats)]
    assert cells_of(spark, points) == [scan_cell(*p) for p in points]


def test_outside_nan_and_missing(spark):
    nan, inf = float("nan"), float("inf")
    points = [(nan, 40.6), (22.9, nan), (inf, 40.6), (22.9, -inf), (0.0, 0.0), (22.8, 40.6)]
    assert cells_of(spark, points) == [0] * 6
    missing = spark.createDataFrame([(None, 40.6), (22.9, None)], "lon double, lat double")
    assert [(r.cellid, r.in_bbox) for r in with_cell(missing).collect()] == [(0, False)] * 2


def test_centres(spark):
    cells = spark.createDataFrame([(i,) for i in range(0, 10001)], "cellid int")
    centre = {r.cellid: (r.lat, r.lon) for r in with_cell_centre(cells).collect()}
    assert centre[1] == pytest.approx((40.699, 22.80125))
    assert centre[10000] == pytest.approx((40.501, 23.04875))
    assert centre[0] == pytest.approx((40.701, 23.04875))
    inside = [(lon, lat) for cell, (lat, lon) in sorted(centre.items()) if cell]
    assert cells_of(spark, inside) == list(range(1, 10001))


def test_random_points(spark):
    rng = np.random.default_rng(5)
    points = list(zip(rng.uniform(22.7, 23.1, 4000), rng.uniform(40.45, 40.75, 4000)))
    assert cells_of(spark, points) == [scan_cell(*p) for p in points]


def test_box_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "points")
    spark.createDataFrame([(22.9, 40.6, 1)], "lon double, lat double, x int").write.parquet(path)
    plan = filter_bbox(spark.read.parquet(path)).select("lon")
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThan(lon,22.8)" in text and "LessThan(lat,40.7)" in text
    assert "x:int" not in text.split("ReadSchema")[-1]
    assert plan.agg(F.count("*")).first()[0] == 1
