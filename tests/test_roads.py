import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.functions.geometry import LON_SCALE
from roadpulse.operators.roads import (
    MOST_GROWTH,
    _locate,
    build_road_index,
    hot_cells,
    match_roads,
)
from roadpulse.schema import BOX, Box

SCHEMA = "segment_id string, x1 double, y1 double, x2 double, y2 double"


def lattice():
    rows = []
    for i in range(11):
        for j in range(11):
            x, y = 22.80 + 0.025 * j, 40.50 + 0.02 * i
            if j < 10:
                rows.append((f"h_{i}_{j}", x, y, 22.80 + 0.025 * (j + 1), y))
            if i < 10:
                rows.append((f"v_{i}_{j}", x, y, x, 40.50 + 0.02 * (i + 1)))
    return rows


def nearest(points, segments, max_dist, box=BOX):
    """Each point against each segment; equal distances to the smaller id."""
    segments = sorted(segments)
    x1, y1, x2, y2 = (np.array([s[i] for s in segments]) for i in range(1, 5))
    dx, dy = (x2 - x1) * LON_SCALE, y2 - y1
    square = dx * dx + dy * dy
    square[square == 0] = 1.0
    out = {}
    for i, (lon, lat) in enumerate(points):
        if not (box.west < lon < box.east and box.south < lat < box.north):
            continue
        px, py = (lon - x1) * LON_SCALE, lat - y1
        t = np.minimum(np.maximum((px * dx + py * dy) / square, 0.0), 1.0)
        d2 = (px - t * dx) ** 2 + (py - t * dy) ** 2
        best = int(np.argmin(d2))
        if d2[best] <= max_dist * max_dist:
            out[i] = segments[best][0]
    return out


def points_df(spark, points):
    rows = [(i, float(lon), float(lat)) for i, (lon, lat) in enumerate(points)]
    return spark.createDataFrame(rows, "i int, lon double, lat double")


def found(matched):
    return {r.i: r.segment_id for r in matched.collect()}


def random_points(n, seed=1, west=22.79, east=23.06, south=40.49, north=40.71):
    rng = np.random.default_rng(seed)
    return list(zip(rng.uniform(west, east, n), rng.uniform(south, north, n)))


def random_roads(n, seed=2, length=0.004, west=22.79, east=23.06, south=40.49, north=40.71):
    rng = np.random.default_rng(seed)
    x, y = rng.uniform(west, east, n), rng.uniform(south, north, n)
    a, b = rng.uniform(-length, length, n), rng.uniform(-length, length, n)
    return [
        (f"r{i}", float(x[i]), float(y[i]), float(x[i] + a[i]), float(y[i] + b[i]))
        for i in range(n)
    ]


@pytest.mark.parametrize("max_dist", [0.001, 0.0002, 0.03])
def test_lattice(spark, max_dist):
    points = random_points(1500)
    roads = spark.createDataFrame(lattice(), SCHEMA)
    got = found(match_roads(points_df(spark, points), roads, max_dist))
    assert got == nearest(points, lattice(), max_dist)


@pytest.mark.parametrize("length", [0.004, 0.2])
def test_crowded_network_is_split_and_stays_exact(spark, length):
    segments = random_roads(400, length=length)
    # A town in one cell of the lookup grid, as many segments as all the rest.
    segments += [
        (f"t{s[0]}", *s[1:])
        for s in random_roads(300, 7, 0.0005, 22.900, 22.902, 40.600, 40.602)
    ]
    points = random_points(800) + random_points(800, 4, 22.899, 22.903, 40.599, 40.603)
    roads = spark.createDataFrame(segments, SCHEMA)
    index = build_road_index(roads, 0.002)
    assert index.depths and index.split_cells > 0
    expected = nearest(points, segments, 0.002)
    assert found(match_roads(points_df(spark, points), index)) == expected
    shuffled = match_roads(points_df(spark, points), index, broadcast_bytes=0, salts=3)
    assert found(shuffled) == expected


def test_cells_that_cannot_be_split(spark):
    # All pieces meet in one point, so some cell holds them all at every level.
    angles = np.linspace(0, np.pi, 60, endpoint=False)
    star = [
        (f"s{i}", 22.9, 40.6, 22.9 + 0.01 * np.cos(a), 40.6 + 0.01 * np.sin(a))
        for i, a in enumerate(angles.tolist())
    ]
    star = [tuple(float(v) if isinstance(v, np.floating) else v for v in row) for row in star]
    points = random_points(300, 3, 22.89, 22.91, 40.59, 40.61) + [(22.9, 40.6)]
    points += random_points(200, 6, 22.89999, 22.90001, 40.59999, 40.60001)
    roads = spark.createDataFrame(star, SCHEMA)
    expected = nearest(points, star, 0.001)
    for deepest in (0, 2, 4):
        index = build_road_index(roads, 0.001, deepest=deepest)
        assert index.widest > index.slots
        assert found(match_roads(points_df(spark, points), index)) == expected
        left = found(match_roads(points_df(spark, points), index, how="left"))
        assert {i: s for i, s in left.items() if s} == expected and len(left) == len(points)


def test_copies_points_and_broken_segments(spark):
    segments = [(f"c{i:03d}", 22.9, 40.6, 22.91, 40.6) for i in range(500)]
    segments += [("dot", 22.95, 40.65, 22.95, 40.65), ("up", 22.97, 40.6, 22.97, 40.61)]
    broken = [
        ("null", None, 40.6, 22.91, 40.6),
        ("nan", float("nan"), 40.6, 22.91, 40.6),
        ("inf", float("inf"), 40.6, 22.91, 40.6),
        (None, 22.9, 40.6, 22.91, 40.6),
    ]
    index = build_road_index(spark.createDataFrame(segments + broken, SCHEMA), 0.001)
    assert not index.depths and index.widest <= 2
    points = [(22.905, 40.6003), (22.9501, 40.65), (22.9705, 40.605), (22.99, 40.69)]
    got = found(match_roads(points_df(spark, points), index))
    assert got == {0: "c000", 1: "dot", 2: "up"}


def test_ties_and_unmatched(spark):
    # All numbers are exact in binary: both roads are 1/512 degrees from the point.
    roads = [("b", 22.875, 40.625, 22.9375, 40.625), ("a", 22.875, 40.62890625, 22.9375, 40.62890625)]
    points = [(22.90625, 40.626953125), (22.7, 40.6), (22.95, 40.55)]
    df = points_df(spark, points)
    table = spark.createDataFrame(roads, SCHEMA)
    assert found(match_roads(df, table, 0.002))[0] == "a"
    kept = found(match_roads(df, table, 0.002, how="left"))
    assert (kept[1], kept[2]) == (None, None)
    missing = spark.createDataFrame([(1, None, 40.6), (2, float("nan"), 40.6)], df.schema)
    assert found(match_roads(missing, table, 0.002)) == {}
    assert found(match_roads(missing, table, 0.002, how="left")) == {1: None, 2: None}
    with pytest.raises(ValueError):
        match_roads(df, table, how="right")


def test_other_areas_and_the_whole_world(spark):
    rng = np.random.default_rng(8)
    segments = [
        (f"w{i}", float(x), float(y), float(x + 0.3), float(y - 0.2))
        for i, (x, y) in enumerate(zip(rng.uniform(-179, 179, 300), rng.uniform(-85, 85, 300)))
    ]
    points = [(s[1] + 0.1, s[2] - 0.05) for s in segments[:150]] + random_points(50)
    roads = spark.createDataFrame(segments, SCHEMA)
    world = Box(-360, 360, -90, 90)
    got = found(match_roads(points_df(spark, points), roads, 0.05, box=None))
    assert got == nearest(points, segments, 0.05, world)
    south = Box(-70, -60, -40, -20)
    got = found(match_roads(points_df(spark, points), roads, 0.05, box=south))
    assert got == nearest(points, segments, 0.05, south)


def test_empty_network(spark):
    roads = spark.createDataFrame([], SCHEMA)
    df = points_df(spark, random_points(5))
    assert match_roads(df, roads).count() == 0
    assert match_roads(df, roads, how="left").count() == 5


def test_events_are_not_shuffled_beside_a_small_index(spark):
    roads = spark.createDataFrame(lattice(), SCHEMA)
    index = build_road_index(roads, 0.001)
    events = spark.range(1000).select(
        F.col("id").cast("int").alias("i"),
        (F.col("id") / 1e4 + 22.9).alias("lon"),
        (F.col("id") / 1e4 + 40.6).alias("lat"),
    )
    plan = match_roads(events, index)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    stream_side = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in stream_side
    large = match_roads(events, index, broadcast_bytes=0)
    assert "ShuffledHashJoin" in large._jdf.queryExecution().executedPlan().toString()


def test_number_of_joins_does_not_depend_on_the_roads(spark):
    hub = [
        (f"h{i:04d}", 22.9, 40.6, 22.9 + 0.002 * math.cos(i), 40.6 + 0.002 * math.sin(i))
        for i in range(1000)
    ]
    events = points_df(spark, random_points(200, 3, 22.89, 22.91, 40.59, 40.61) + [(22.9, 40.6)])
    joins, first = {}, build_road_index(spark.createDataFrame(hub, SCHEMA), 0.001, deepest=0)
    for deepest in (1, 2, 4):
        index = build_road_index(spark.createDataFrame(hub, SCHEMA), 0.001, deepest=deepest)
        for limit in (0, 1 << 30):
            plan = match_roads(events, index, broadcast_bytes=limit)
            plan = plan._jdf.queryExecution().executedPlan().toString()
            joins.setdefault(limit, set()).add(plan.count("HashJoin"))
        assert found(match_roads(events, index)) == found(match_roads(events, first))
        assert index.size_bytes <= (MOST_GROWTH + 1) * first.size_bytes
    assert joins == {0: {2}, 1 << 30: {2}}


def test_only_hot_cells_are_copied(spark):
    """A third of the events in one cell: its rows of the index are copied, no others."""
    segments = random_roads(400)
    crowd = [(22.9001 + i % 7 / 1e6, 40.6001) for i in range(1000)]
    points = random_points(2000) + crowd
    roads = spark.createDataFrame(segments, SCHEMA)
    index = build_road_index(roads, 0.001)
    events = points_df(spark, points)
    names = events.columns
    located = _locate(events, index, 0)
    keys = ["_level", "_ix", "_iy"] if index.depths else ["_ix", "_iy"]
    heavy, salts = hot_cells(located, keys, index)
    there = located.where(F.xxhash64(*keys).isin(heavy))
    assert len(heavy) == 1 and there.count() >= 1000 and 1 < salts <= 4
    matched = match_roads(events, index, broadcast_bytes=0)
    assert found(matched) == nearest(points, segments, 0.001)
    plan = matched._jdf.queryExecution().optimizedPlan().toString()
    copied = [line for line in plan.splitlines() if "explode(sequence(" in line]
    assert len(copied) == 1 and str(heavy[0]) in copied[0]
    # Without such a cell nothing is copied.
    even = points_df(spark, random_points(2000))
    assert hot_cells(_locate(even, index, 0), keys, index) == ([], 1)
    plan = match_roads(even, index, broadcast_bytes=0)._jdf.queryExecution().optimizedPlan()
    assert "explode" not in plan.toString() and "_salt" not in plan.toString()
