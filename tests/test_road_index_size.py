"""Size of the road index and of its copies, on rows built here."""

from dataclasses import replace

from pyspark.sql import functions as F
from test_roads import SCHEMA, found, nearest, points_df, random_points, random_roads

from roadpulse.operators import roads
from roadpulse.operators.roads import build_road_index, match_roads
from roadpulse.session import materialize

TOWN = dict(west=22.90, east=22.91, south=40.60, north=40.61)


def test_a_large_dense_index_stays_in_proportion_to_its_cells(spark, monkeypatch):
    # As if the index were beyond the size up to which cells are divided at will.
    monkeypatch.setattr(roads, "SMALL_ENTRIES", 0, raising=False)
    segments = random_roads(1500, 5, 0.002, **TOWN)
    table = spark.createDataFrame(segments, SCHEMA)
    entries = F.sum(F.size("candidates"))
    first = build_road_index(table, 0.001, deepest=0).cells.agg(entries).first()[0]
    index = build_road_index(table, 0.001)
    assert index.widest > index.slots
    assert index.cells.agg(entries).first()[0] <= 2 * first
    points = random_points(400, 9, **TOWN)
    expected = nearest(points, segments, 0.001)
    assert found(match_roads(points_df(spark, points), index)) == expected


def test_building_a_large_dense_index_stores_few_rows_beside_it(spark, monkeypatch):
    """What all road matches store and shuffle on the way to the index, level by level."""
    monkeypatch.setattr(roads, "SMALL_ENTRIES", 0, raising=False)
    stored = []

    def counted(rows, purpose, *spread_by):
        table = materialize(rows, purpose, *spread_by)
        stored.append((purpose, table.count()))
        return table

    monkeypatch.setattr(roads, "materialize", counted)
    build_road_index(spark.createDataFrame(random_roads(1500, 5, 0.002, **TOWN), SCHEMA), 0.001)
    assert stored[0][0] == "road-cells"
    assert sum(rows for _, rows in stored) <= 8 * stored[0][1]


def test_parts_hold_only_what_can_be_nearest_in_them(spark, monkeypatch):
    """A reach far beyond the distances in a dense network: the bound on the index leaves room for
    the parts, as most segments are far from most of them."""
    monkeypatch.setattr(roads, "SMALL_ENTRIES", 40_000)
    segments = random_roads(1500, 5, 0.002, **TOWN)
    index = build_road_index(spark.createDataFrame(segments, SCHEMA), 0.01, deepest=1)
    assert index.depths == 1 and index.widest < 500
    points = random_points(400, 9, **TOWN)
    expected = nearest(points, segments, 0.01)
    assert found(match_roads(points_df(spark, points), index)) == expected


def test_a_stream_does_not_copy_a_large_index(spark, tmp_path):
    index = build_road_index(spark.createDataFrame(random_roads(20), SCHEMA), 0.001)
    stream = spark.readStream.schema("i int, lon double, lat double").parquet(str(tmp_path))

    def copied(size):
        matched = match_roads(stream, replace(index, size_bytes=size))
        return "_salt" in matched._jdf.queryExecution().analyzed().toString()

    assert copied(256 << 20) and not copied(1 << 30)
