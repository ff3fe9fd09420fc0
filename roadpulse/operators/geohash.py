"""Geohash operators.

Per-event work is two shifts; every aggregate runs on integer cell coordinates and the
interleaved number or its text is made from the (few) aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geohash as gh
from roadpulse.functions.text import print_window_time

X, Y = "_x", "_y"


def with_geohash(events: DataFrame, bits: int = 20, column: str = "geohash") -> DataFrame:
    """Add the base-32 geohash of each point."""
    gh.check_bits(bits, text=True)
    return events.withColumn(column, gh.text(_number(bits), bits))


def with_geohash_long(events: DataFrame, bits: int, column: str = "geohash_long") -> DataFrame:
    """Add the geohash of each point as a number that carries its precision."""
    gh.check_bits(bits)
    return events.withColumn(column, gh.tag(_number(bits), bits))


def geohash_density(events: DataFrame, bits: int = 20) -> DataFrame:
    """Events per geohash cell: ``geohash, records``."""
    gh.check_bits(bits, text=True)
    return _cells(events, bits).select(_text(bits).alias("geohash"), "records")


def geohash_long_density(events: DataFrame, bits: int) -> DataFrame:
    """Events per geohash cell: ``geohash_long, records``; any number of bits."""
    gh.check_bits(bits)
    return _cells(events, bits).select(_tagged(bits).alias("geohash_long"), "records")


def with_geohash_bounds(
    cells: DataFrame, bits: int | None = None, column: str = "geohash_long"
) -> DataFrame:
    """Add centre, error and bounds (minimum inside, maximum outside) of each cell.

    ``column`` holds base-32 text or tagged numbers, all of ``bits`` bits. Without ``bits``
    it holds tagged numbers, each with the precision of its tag; NULL without a tag.
    """
    if bits is None:
        x, y, precision = gh.deinterleave_tagged(F.col(column))
        cut = cells.withColumns({X: x, Y: y, "_precision": precision})
        x_bits = F.shiftright(F.col("_precision") + 1, 1)
        y_bits = F.shiftright(F.col("_precision"), 1)
        lon, lon_err = gh.tagged_centre(F.col(X), x_bits, 360.0)
        lat, lat_err = gh.tagged_centre(F.col(Y), y_bits, 180.0)
        placed = cut.withColumns({"lat": lat, "lon": lon, "lat_err": lat_err, "lon_err": lon_err})
        return placed.drop(X, Y, "_precision").withColumns(_edges())
    gh.check_bits(bits)
    if dict(cells.dtypes)[column] == "string":
        number = gh.from_text(F.col(column))
    else:
        number = gh.untag(F.col(column), bits)
    x, y = gh.deinterleave(number, bits)
    placed = cells.withColumns({"lat": gh.lat_centre(y, bits), "lon": gh.lon_centre(x, bits)})
    lat_err, lon_err = F.lit(gh.lat_error(bits)), F.lit(gh.lon_error(bits))
    return placed.withColumns({"lat_err": lat_err, "lon_err": lon_err}).withColumns(_edges())


def _edges() -> dict:
    return {
        "min_lat": F.col("lat") - F.col("lat_err"),
        "max_lat": F.col("lat") + F.col("lat_err"),
        "min_lon": F.col("lon") - F.col("lon_err"),
        "max_lon": F.col("lon") + F.col("lon_err"),
    }


def untag_geohash(cells: DataFrame, column: str = "geohash_long") -> DataFrame:
    """Replace each tagged number by the plain one and add its ``precision``."""
    precision = gh.tagged_precision(F.col(column))
    plain = F.col(column).bitwiseAND(gh.ones(precision))
    return cells.withColumns({column: plain, "precision": precision})


def shift_geohash(
    cells: DataFrame, dx: int, dy: int, bits: int | None = None, column: str = "geohash_long"
) -> DataFrame:
    """Replace each tagged cell by the one ``dx`` cells east and ``dy`` cells north, of
    ``bits`` bits or, without ``bits``, of the precision of its tag."""
    if bits is None:
        x, y, precision = gh.deinterleave_tagged(F.col(column))
        cut = cells.withColumns({X: x, Y: y, "_precision": precision})
        wide = gh.ones(F.shiftright(F.col("_precision") + 1, 1))
        high = gh.ones(F.shiftright(F.col("_precision"), 1))
        # Borders wrap; a negative step is its complement, so masks make it fit.
        x = (F.col(X) + F.lit(dx).cast("bigint")).bitwiseAND(wide)
        y = (F.col(Y) + F.lit(dy).cast("bigint")).bitwiseAND(high)
        moved = gh.interleave_tagged(x, y, F.col("_precision"))
        return cut.withColumn(column, moved).drop(X, Y, "_precision")
    gh.check_bits(bits)
    x, y = gh.deinterleave(gh.untag(F.col(column), bits), bits)
    x, y = gh.shift(x, y, dx, dy, bits)
    return cells.withColumn(column, gh.tag(gh.interleave(x, y, bits), bits))


def north(cells: DataFrame, bits: int | None = None, column: str = "geohash_long") -> DataFrame:
    return shift_geohash(cells, 0, 1, bits, column)


def east(cells: DataFrame, bits: int | None = None, column: str = "geohash_long") -> DataFrame:
    return shift_geohash(cells, 1, 0, bits, column)


def south(cells: DataFrame, bits: int | None = None, column: str = "geohash_long") -> DataFrame:
    return shift_geohash(cells, 0, -1, bits, column)


def west(cells: DataFrame, bits: int | None = None, column: str = "geohash_long") -> DataFrame:
    return shift_geohash(cells, -1, 0, bits, column)


def geohash_neighbour_density(
    events: DataFrame, bits: int = 20, minutes: int | None = None
) -> DataFrame:
    """Per occupied cell its events, and those of it and its 8 neighbours.

    Cells are counted first; each count is then dealt out to the cells around it, with
    a mark on the cell's own share. A marked sum is an occupied cell, so no join is
    needed to drop the empty ones.

    With ``minutes`` all that is done per tumbling window, whose end is ``timestamp``. Both
    sums are then windowed, so a stream with a watermark gives the same rows, each window
    once.
    """
    gh.check_bits(bits, text=True)
    wide, high = 1 << gh.x_bits(bits), 1 << gh.y_bits(bits)
    # As a set: with one or two cells on an axis, both neighbours are the same cell.
    moves = sorted({(dx % wide, dy % high) for dx in (-1, 0, 1) for dy in (-1, 0, 1)})
    targets = []
    for dx, dy in moves:
        x, y = gh.shift(F.col(X), F.col(Y), dx, dy, bits)
        own = F.lit(dx == 0 and dy == 0)
        targets.append(F.struct(x.alias("x"), y.alias("y"), own.alias("own")))
    keys, label = _window(minutes)
    dealt = _cells(events, bits, minutes).select(*keys, "records", F.inline(F.array(*targets)))
    return (
        dealt.groupBy(*keys, F.col("x").alias(X), F.col("y").alias(Y))
        .agg(
            F.sum(F.when(F.col("own"), F.col("records"))).alias("records"),
            F.sum("records").alias("area_records"),
        )
        .where(F.col("records").isNotNull())
        .select(_text(bits).alias("geohash"), *label, "records", "area_records")
    )


def _window(minutes: int | None) -> tuple[list[str], list]:
    """Grouping key and label of windows, if there are any."""
    if minutes is None:
        return [], []
    return ["window"], [print_window_time(F.col("window.end")).alias("timestamp")]


def covering_geohash(events: DataFrame, key: str = "device_id", bits: int = 60) -> DataFrame:
    """Per key the smallest geohash cell that holds all its points.

    The common leading bits of a set of numbers are those of its minimum and maximum,
    on each axis; so four running extremes per key are enough.
    """
    gh.check_bits(bits)
    extremes = (
        events.select(key, *_xy(bits))
        .groupBy(key)
        .agg(
            F.min(X).alias("_x0"), F.max(X).alias("_x1"),
            F.min(Y).alias("_y0"), F.max(Y).alias("_y1"),
        )
    )
    # Bits to give up, counted in interleaved bits: the lowest bit belongs to x when
    # ``bits`` is odd and to y when it is even.
    x_cut = gh.bit_length(F.col("_x0").bitwiseXOR(F.col("_x1"))) * 2
    y_cut = gh.bit_length(F.col("_y0").bitwiseXOR(F.col("_y1"))) * 2
    if bits % 2:
        x_cut = F.greatest(x_cut - 1, F.lit(0))
    else:
        y_cut = F.greatest(y_cut - 1, F.lit(0))
    cut = extremes.select(
        key,
        gh.interleave(F.col("_x0"), F.col("_y0"), bits).alias("_number"),
        F.greatest(x_cut, y_cut).alias("reduction"),
    )
    number, precision = F.col("_number"), F.lit(bits) - F.col("reduction")
    one = F.lit(1).cast("bigint")
    tagged = F.call_function("shiftright", number, F.col("reduction")).bitwiseOR(
        F.lit(gh.TAGGED).cast("bigint").bitwiseOR(F.call_function("shiftleft", one, precision))
    )
    return cut.select(
        key,
        "reduction",
        precision.alias("precision"),
        tagged.alias("geohash_long"),
        F.substring(
            gh.text(_pad(number, bits), _padded(bits)), F.lit(1), F.floor(precision / 5).cast("int")
        ).alias("geohash"),
    )


def geohash_rollup(events: DataFrame, *lengths: int) -> DataFrame:
    """Events per cell at several geohash lengths at once: ``precision, geohash, records``.

    The grand total is the row of length 0. Events are counted at the finest length first; only
    those counts are rolled up.
    """
    lengths = tuple(sorted({n for n in lengths if n > 0})) or (4, 5, 6)
    finest = lengths[-1] * 5
    cells = geohash_density(events, finest)
    prefixes = {n: f"_p{n}" for n in lengths}
    named = cells.select(
        *(F.substring("geohash", 1, n).alias(name) for n, name in prefixes.items()), "records"
    )
    # In a roll-up the finest non-null prefix names the cell.
    names = list(prefixes.values())
    return (
        named.rollup(*names)
        .agg(F.sum("records").alias("records"))
        .select(
            F.coalesce(*(F.col(name) for name in reversed(names)), F.lit("")).alias("geohash"),
            "records",
        )
        .select(F.length("geohash").alias("precision"), "geohash", "records")
    )


def geohash_rollup_windows(events: DataFrame, minutes: int, *lengths: int) -> DataFrame:
    """``geohash_rollup`` per tumbling window: ``precision, geohash, timestamp, records``.

    Counts of the finest cells are dealt out to their prefixes, and both sums are windowed: a
    stream with a watermark gives the rows of a batch, each window once.
    """
    lengths = (0, *sorted({n for n in lengths if n > 0})) if lengths else (0, 4, 5, 6)
    finest = lengths[-1] * 5
    gh.check_bits(finest, text=True)
    cells = _cells(events, finest, minutes)
    keys, label = _window(minutes)
    prefix = (F.struct(F.lit(n).alias("precision"), F.substring("_text", 1, n).alias("geohash")) for n in lengths)
    named = cells.select(*keys, "records", _text(finest).alias("_text"))
    dealt = named.select(*keys, "records", F.inline(F.array(*prefix)))
    sums = dealt.groupBy(*keys, "precision", "geohash").agg(F.sum("records").alias("records"))
    return sums.select("precision", "geohash", *label, "records")


def _xy(bits: int):
    return gh.cell_x(F.col("lon"), bits).alias(X), gh.cell_y(F.col("lat"), bits).alias(Y)


def _cells(events: DataFrame, bits: int, minutes: int | None = None) -> DataFrame:
    if minutes is None:
        cells = events.select(*_xy(bits)).groupBy(X, Y)
    else:
        window = F.window("timestamp", f"{minutes} minutes")
        cells = events.select("timestamp", *_xy(bits)).groupBy(window, X, Y)
    return cells.agg(F.count(F.lit(1)).alias("records"))


def _number(bits: int):
    return gh.interleave(gh.cell_x(F.col("lon"), bits), gh.cell_y(F.col("lat"), bits), bits)


def _text(bits: int):
    return gh.text(gh.interleave(F.col(X), F.col(Y), bits), bits)


def _tagged(bits: int):
    return gh.tag(gh.interleave(F.col(X), F.col(Y), bits), bits)


def _padded(bits: int) -> int:
    return -(-bits // 5) * 5


def _pad(number, bits: int):
    return F.shiftleft(number, _padded(bits) - bits)
