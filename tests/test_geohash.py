import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.functions import geohash as gh
from roadpulse.operators import geohash as op

POINT = (40.626444, 22.948426)


def halve(lat, lon, bits):
    """Geohash bits by halving the world, longitude first."""
    spans = {"lon": [-180.0, 180.0], "lat": [-90.0, 90.0]}
    number = 0
    for i in range(bits):
        axis, value = ("lon", lon) if i % 2 == 0 else ("lat", lat)
        low, high = spans[axis]
        middle = (low + high) / 2
        upper = value >= middle
        number = number * 2 + upper
        spans[axis] = [middle, high] if upper else [low, middle]
    return number, spans


def points(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"lat double, lon double{extra}")


def random_points(n, seed=3):
    rng = np.random.default_rng(seed)
    return [(float(a), float(b)) for a, b in zip(rng.uniform(-90, 90, n), rng.uniform(-180, 180, n))]


@pytest.mark.parametrize("bits,text", [(0, ""), (10, "sx"), (25, "sx0r4"), (60, "sx0r45yd1n4d")])
def test_known_texts(spark, bits, text):
    assert op.with_geohash(points(spark, [POINT]), bits).first().geohash == text


@pytest.mark.parametrize("bits", [0, 1, 2, 5, 20, 33, 52, 60, 61])
def test_numbers_and_bounds(spark, bits):
    rows = random_points(300) + [POINT, (0.0, 0.0), (-90.0, -180.0)]
    df = op.with_geohash_long(points(spark, rows), bits)
    df = df.withColumn("p", gh.tagged_precision(F.col("geohash_long")))
    cells = op.with_geohash_bounds(df.drop("lat", "lon"), bits).collect()
    for (lat, lon), cell in zip(rows, cells):
        number, spans = halve(lat, lon, bits)
        assert cell.geohash_long == number | 1 << 62 | 1 << bits
        assert cell.p == bits
        assert [cell.min_lat, cell.max_lat] == pytest.approx(spans["lat"], abs=1e-12)
        assert [cell.min_lon, cell.max_lon] == pytest.approx(spans["lon"], abs=1e-12)


def test_text_decodes_to_a_cell_that_holds_the_point(spark):
    df = op.with_geohash(points(spark, random_points(200)).withColumn("a", F.col("lat")), 60)
    df = df.withColumnRenamed("lon", "b").drop("lat")
    for r in op.with_geohash_bounds(df, 60, "geohash").collect():
        assert r.min_lat <= r.a < r.max_lat and r.min_lon <= r.b < r.max_lon


@pytest.mark.parametrize("bits", [4, 5, 30, 33, 61])
@pytest.mark.parametrize("dx,dy", [(0, 1), (1, 0), (0, -1), (-1, 0), (3, -2), (-5, 7)])
def test_shift(spark, bits, dx, dy):
    nx, ny = gh.x_bits(bits), gh.y_bits(bits)
    rows = random_points(60)
    df = op.shift_geohash(op.with_geohash_long(points(spark, rows), bits), dx, dy, bits)
    for (lat, lon), r in zip(rows, df.collect()):
        number, _ = halve(lat, lon, bits)
        digits = format(number, f"0{bits}b")
        x, y = int(digits[0::2], 2), int(digits[1::2], 2)
        x, y = format((x + dx) % 2**nx, f"0{nx}b"), format((y + dy) % 2**ny, f"0{ny}b")
        moved = "".join(a + b for a, b in zip(x, y.ljust(nx)))
        assert r.geohash_long == int(moved.replace(" ", ""), 2) | 1 << 62 | 1 << bits


def test_four_directions(spark):
    cell = op.with_geohash_long(points(spark, [POINT]), 30)
    start = cell.first().geohash_long
    around = op.west(op.south(op.east(op.north(cell, 30), 30), 30), 30)
    assert around.first().geohash_long == start
    assert op.north(cell, 30).first().geohash_long != start


@pytest.mark.parametrize("bits", [5, 30])
def test_neighbour_density(spark, bits):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b)) for a, b in zip(rng.uniform(40.6, 40.65, 300), rng.uniform(22.9, 22.95, 300))]
    rows += [(0.1, 179.999)] * 3 + [(0.1, -179.999)] * 2
    counts = {}
    for lat, lon in rows:
        digits = format(halve(lat, lon, bits)[0], f"0{bits}b")
        cell = int(digits[0::2], 2), int(digits[1::2], 2)
        counts[cell] = counts.get(cell, 0) + 1
    wide, high = 2 ** gh.x_bits(bits), 2 ** gh.y_bits(bits)
    expected = sorted(
        (n, sum(
            counts.get(c, 0)
            for c in {((x + i) % wide, (y + j) % high) for i in (-1, 0, 1) for j in (-1, 0, 1)}
        ))
        for (x, y), n in counts.items()
    )
    got = op.geohash_neighbour_density(points(spark, rows), bits).collect()
    assert sorted((r.records, r.area_records) for r in got) == expected


@pytest.mark.parametrize("bits", [60, 59, 21])
def test_covering(spark, bits):
    rng = np.random.default_rng(9)
    rows, sets = [], {}
    for key in range(120):
        lat, lon, size = rng.uniform(-80, 80), rng.uniform(-170, 170), 10.0 ** rng.uniform(-9, 1)
        for _ in range(int(rng.integers(1, 6))):
            point = (float(lat + rng.uniform(0, size)), float(lon + rng.uniform(0, size)))
            rows.append((*point, key))
            sets.setdefault(key, []).append(halve(*point, bits)[0])
    got = op.covering_geohash(points(spark, rows, ", key int"), "key", bits).collect()
    assert len(got) == len(sets)
    for r in got:
        cut = next(c for c in range(bits + 1) if len({n >> c for n in sets[r.key]}) == 1)
        prefix = sets[r.key][0] >> cut
        assert (r.reduction, r.precision) == (cut, bits - cut)
        assert r.geohash_long == prefix | 1 << 62 | 1 << (bits - cut)
        chars = (bits - cut) // 5
        text = "".join(
            gh.ALPHABET[prefix >> (bits - cut - 5 * (i + 1)) & 31] for i in range(chars)
        )
        assert r.geohash == text


def test_rollup_totals(spark):
    rows = random_points(500)
    got = op.geohash_rollup(points(spark, rows), 1, 2, 3).collect()
    for n in (0, 1, 2, 3):
        assert sum(r.records for r in got if r.precision == n) == 500
    assert {r.precision for r in got} == {0, 1, 2, 3}


def test_density_counts_before_it_makes_text(spark):
    plan = op.geohash_density(points(spark, [POINT]), 20)._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    partial = next(i for i, line in enumerate(lines) if "partial_count" in line)
    assert not any("concat(" in line for line in lines[partial:])


def test_bad_precision():
    for bits in (-1, 62):
        with pytest.raises(ValueError):
            gh.check_bits(bits)
    with pytest.raises(ValueError):
        gh.check_bits(12, text=True)
