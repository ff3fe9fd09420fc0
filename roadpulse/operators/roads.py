"""Map matching: the nearest road segment within ``max_dist`` of each event.

The road table is spread over the cells of a lookup grid, so an event looks in exactly
one cell and the match is a plain equi-join without state: one row in, at most one row
out, in batch and in streams. The side that grows with traffic (events) is never
exploded, grouped or sorted.

Crowded cells are divided, again and again, and a segment goes down only into those parts of
a cell where no other one is nearer to every point. That is exact: no number of candidates
is cut off. As roads cross, the parts of a dense network grow faster than
the network, so a large index is divided only while it stays about as long as the table of
roads by cells. A cell that stays crowded lists for each part of it the places of the
candidates that can be nearest there, a few bytes each; an event compares those of its part,
and those beyond the slots in an array.

The index is stored when it is built. Matching is two joins at most, whatever the roads
look like: one with the cells that were divided, which tells how deep an event has to
look, and one with the packed cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geometry import (
    LON_SCALE,
    along_segment,
    offset_squared,
    segment_shape,
    squared_distance,
)
from roadpulse.functions.grid import inside
from roadpulse.functions.rows import keep_if
from roadpulse.schema import BOX, Box
from roadpulse.session import materialize

SLOTS = 16  # candidates compared in generated code; a cell with more is split
SPLIT = 4  # a crowded cell becomes SPLIT x SPLIT cells; a power of 2
DEEPEST = 4  # levels of splitting
MOST_GROWTH = 16  # splitting stops before the index has so many times its first entries
LARGE_GROWTH = 2  # the same where the index would have more entries than a small one
SMALL_ENTRIES = 1 << 20
BROADCAST_BYTES = 128 << 20
MOST_HOT = 10_000  # hot cells that are told apart
HOT_EVENTS = 100  # a cell with fewer events is never hot
STREAM_SALTS = 32
STREAM_COPIES_BYTES = 512 << 20  # of all copies that a micro-batch shuffles
NOWHERE = -(1 << 30)  # cell numbers below it belong to no cell
SLACK = 1e-6  # in cells; far above the rounding of the cell arithmetic

# Size of a packed candidate next to its id: five doubles and the row's own overhead.
CANDIDATE_BYTES = 96
SPLIT_BYTES = 64
PLACES_BYTES = 512  # the lists of a crowded cell, without their places

WORLD = Box(west=-360.0, east=360.0, south=-90.0, north=90.0)
CELL = ["level", "ix", "iy"]
SHAPE = ["x1", "y1", "x2", "y2"]
PART = ["ix", "iy", "segment_id"]
WORD = 64


@dataclass(frozen=True)
class RoadIndex:
    """Road segments ready for lookup."""

    cells: DataFrame  # level, ix, iy, candidates, places
    # Divided cells of the first level, and bit fields of those divided again below them.
    tops: DataFrame | None = field(repr=False)
    depths: int  # levels of divided cells
    cell_size: float
    max_dist: float
    box: Box
    slots: int
    widest: int  # most candidates of a cell
    size_bytes: int
    split_cells: int


def build_road_index(
    segments: DataFrame,
    max_dist: float,
    box: Box | None = BOX,
    cell_size: float | None = None,
    slots: int = SLOTS,
    deepest: int = DEEPEST,
) -> RoadIndex:
    """Spread, thin out, pack and store the road table. ``segments`` is a static table.

    The spread table is stored once and measured; there is one more round for each level
    of splitting where the network is crowded. Splitting ends at ``deepest`` levels or
    where it would make the index ``MOST_GROWTH`` times as long, ``LARGE_GROWTH`` times
    beyond ``SMALL_ENTRIES``; cells are then kept with all their candidates. Parts are stored
    for a try only if they are no more than ``LARGE_GROWTH`` times the spread table or that
    bound. The tables are in the shared scratch folder.
    """
    box = box or WORLD
    size = cell_size or max_dist
    # Cell numbers stay 32-bit integers at every level.
    deepest = max(0, min(deepest, int(math.log((1 << 31) * size / 720.0, SPLIT))))

    # Even shares of the segments, which are few beside their cells.
    tasks = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shapes = _distinct_shapes(_near_box(segments, box, max_dist))
    shapes = shapes.repartition(tasks, F.xxhash64(*SHAPE))
    level = materialize(_spread(shapes, size, max_dist, box), "road-cells")
    spread = level.count()
    leaves, splits, split_cells, kept, most = [], [], 0, 0, 0
    size_bytes, widest, above = 0, 0, None
    for depth in range(deepest + 1):
        held = level.groupBy("ix", "iy").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.length("segment_id")).alias("id_chars")
        )
        held = materialize(held, "road-cell-sizes")
        crowded = held.where(F.col("n") > slots).select("ix", "iy")
        number = crowded.count()
        few = number * SPLIT_BYTES <= BROADCAST_BYTES
        marked, rest, sizes = None, level, [_cell_sizes(held.where(F.col("n") <= slots), slots)]
        if number:
            # Only what can be nearest somewhere in its cell is kept, and goes down only into
            # the parts where it can.
            marked = _mark_parts(level, crowded, few, size / SPLIT ** (depth + 1), max_dist)
            marked = materialize(marked, "road-cell-parts")
            rest = level.join(_build_side(crowded, few), ["ix", "iy"], "left_anti")
            left = marked.groupBy("ix", "iy").agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.length("segment_id")).alias("id_chars"),
                F.sum(F.bit_count("parts")).alias("places"),
            )
            sizes.append(_cell_sizes(left, slots))
        leaf = _totals(sizes[0])
        hot = _totals(sizes[-1]) if number else (0, 0, 0, 0)
        here = leaf[2] + hot[2]
        if above is None:
            most = max(LARGE_GROWTH * here, min(MOST_GROWTH * here, SMALL_ENTRIES), 1)
        elif kept + here > most:
            # The cells above stay as they are.
            splits.pop()
            split_cells, depth, marked, hot = above
            leaves.append(_leaf(marked, depth))
            size_bytes, widest = size_bytes + hot[0], max(widest, hot[1])
            break
        size_bytes, widest, kept = size_bytes + leaf[0], max(widest, leaf[1]), kept + leaf[2]
        leaves.append(_leaf(rest, depth))
        if not number:
            break
        if depth == deepest or kept + hot[3] > max(most, LARGE_GROWTH * spread):
            leaves.append(_leaf(marked, depth))
            size_bytes, widest = size_bytes + hot[0], max(widest, hot[1])
            break
        above = split_cells, depth, marked, hot
        splits.append(crowded)
        split_cells += number
        # The parts are spread as evenly as the level.
        level = materialize(_divide(marked), "road-cells", *PART)

    return RoadIndex(
        cells=materialize(
            _with_places(_pack(reduce(DataFrame.unionByName, leaves)), slots),
            "road-index",
        ),
        tops=materialize(_tops(splits), "road-tops") if splits else None,
        depths=len(splits),
        cell_size=size,
        max_dist=max_dist,
        box=box,
        slots=slots,
        widest=widest,
        size_bytes=size_bytes,
        split_cells=split_cells,
    )


def _cell_sizes(cells: DataFrame, slots: int) -> DataFrame:
    """Entries, bytes when packed and places of cells."""
    places = F.col("places") if "places" in cells.columns else F.lit(0)
    lists = F.when(F.col("n") > slots, PLACES_BYTES + 4 * places).otherwise(0)
    packed = F.col("n") * CANDIDATE_BYTES + F.col("id_chars") * 4 + lists
    return cells.select("n", packed.alias("bytes"), places.cast("bigint").alias("places"))


def _totals(cells: DataFrame) -> tuple[int, int, int, int]:
    """Bytes, most entries of a cell, entries and places."""
    totals = cells.agg(F.sum("bytes"), F.max("n"), F.sum("n"), F.sum("places")).first()
    return tuple(value or 0 for value in totals)


def _words(depth: int) -> int:
    """Words of the bit field of the cells at ``depth`` in one of the first level."""
    return max(1, SPLIT ** (2 * depth) // WORD)


def _code(ix: Column, iy: Column, depth: int) -> Column:
    """Number of a cell among those at its depth in one of the first level."""
    mask, shift = SPLIT**depth - 1, int(math.log2(SPLIT)) * depth
    return F.shiftleft(ix.bitwiseAND(F.lit(mask)), shift) + iy.bitwiseAND(F.lit(mask))


def _tops(splits: list[DataFrame]) -> DataFrame:
    """One row for each divided cell of the first level: ``ix``, ``iy`` and for each deeper
    level with divided cells a bit field ``bits<level>`` of them."""
    tops = splits[0]
    for depth, split in enumerate(splits[1:], 1):
        shift = int(math.log2(SPLIT)) * depth
        code = _code(F.col("ix"), F.col("iy"), depth)
        bits = split.select(
            F.shiftright("ix", shift).alias("ix"),
            F.shiftright("iy", shift).alias("iy"),
            F.floor(code / WORD).cast("int").alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (code % WORD).cast("int")).alias("bit"),
        )
        words = bits.groupBy("ix", "iy", "word").agg(F.bit_or("bit").alias("bits"))
        pairs = words.groupBy("ix", "iy").agg(
            F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("_map")
        )
        every = F.sequence(F.lit(0), F.lit(_words(depth) - 1))
        full = F.transform(every, lambda w: F.coalesce(F.col("_map")[w], F.lit(0).cast("bigint")))
        pairs = pairs.select("ix", "iy", full.alias(f"bits{depth}"))
        tops = tops.join(pairs, ["ix", "iy"], "left")
    return tops


def match_roads(
    events: DataFrame,
    roads: DataFrame | RoadIndex,
    max_dist: float = 0.001,
    how: str = "inner",
    box: Box | None = BOX,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Add ``segment_id`` and ``distance`` (degrees of latitude) to each event.

    ``how="inner"`` drops events with no segment in reach or outside the box, ``"left"``
    keeps them with NULLs. Equal distances go to the smaller id. Give a ``RoadIndex``
    to use one index in several jobs.

    An index whose measured size is within ``broadcast_bytes`` is broadcast and events
    are not shuffled. A larger one is joined by shuffle on the cell. There a batch first
    measures which cells are hot; only their rows of the index are copied and only their
    events divided over the copies. A stream, whose hot cells to come are not known, copies
    all cells up to ``STREAM_SALTS`` times, as often as the copies stay within
    ``STREAM_COPIES_BYTES``: each micro-batch shuffles them. With ``salts`` all cells are
    copied so many times.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, got {how!r}")
    index = roads if isinstance(roads, RoadIndex) else build_road_index(roads, max_dist, box)
    names = events.columns
    lon, lat = F.col("lon"), F.col("lat")

    if how == "inner":
        events = events.where(inside(lon, lat, index.box))
    located = _locate(events, index, broadcast_bytes)

    keys = ["_level", "_ix", "_iy"] if index.depths else ["_ix", "_iy"]
    cells = index.cells.withColumnsRenamed({name: f"_{name}" for name in CELL})
    small = index.size_bytes <= broadcast_bytes
    if not small:
        hot = F.lit(True)
        if salts is None and events.isStreaming:
            salts = max(1, min(STREAM_SALTS, STREAM_COPIES_BYTES // max(1, index.size_bytes)))
        elif salts is None:
            heavy, salts = hot_cells(located, keys, index)
            hot = F.xxhash64(*keys).isin(heavy) if heavy else F.lit(False)
        if salts > 1:
            # By the event, so that one large input split is divided as well.
            salt = F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int")
            located = located.withColumn("_salt", F.when(hot, salt).otherwise(0))
            copies = F.sequence(F.lit(0), F.when(hot, salts - 1).otherwise(0))
            cells = cells.withColumn("_salt", F.explode(copies))
            keys = [*keys, "_salt"]

    pack, given = "_candidates", []
    part = cells.select(*keys, F.col("candidates").alias(pack))
    if index.widest > index.slots:
        part = cells.select(*part.columns[:-1], F.col("candidates").alias(pack), "places")
        given = [F.get("places", F.col("_part")).alias("_places")]
    located = located.join(_build_side(part, small), keys, how).select(*names, pack, *given)
    located, found = _nearest_of_slots(located, names, pack, index)
    # The result leaves through a generator: a filter on it would be pushed below the
    # search and run the search twice.
    matched = located.select(*names, F.inline(found) if how == "inner" else F.inline_outer(found))
    return matched.select(*names, "segment_id", F.sqrt("_d2").alias("distance"))


def hot_cells(located: DataFrame, keys: list[str], index: RoadIndex) -> tuple[list[int], int]:
    """Hashes of the cells with more events than half an even share of a task, and over how
    many copies the largest has to be divided. ``located`` are events with their cells.

    One more pass over the coordinates, with a sketch of the heaviest cells whose size does not
    depend on the number of cells; so as many tasks as there are, at most twice that many
    cells are found.
    """
    tasks = int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(2 * tasks, MOST_HOT)
    inner = located.where(inside(F.col("lon"), F.col("lat"), index.box))
    code = F.xxhash64(*keys).alias("code")
    heaviest = F.expr(f"approx_top_k(code, {wanted}, {8 * wanted})")
    total, found = inner.select(code).agg(F.count(F.lit(1)), heaviest).first()
    share = (total or 0) / (2 * tasks)
    heavy = {item["item"]: item["count"] for item in found or [] if item["count"] > max(share, HOT_EVENTS)}
    if not heavy:
        return [], 1
    return sorted(heavy), min(tasks, math.ceil(max(heavy.values()) / share))


def _in_reach_of(index: RoadIndex, best: Column) -> Column:
    """Array of the nearest candidate, or of nothing when it is too far; one evaluation."""
    return F.filter(F.array(best), lambda b: b["_d2"] <= index.max_dist * index.max_dist)


def _nearest_of_slots(
    located: DataFrame, names: list[str], pack: str, index: RoadIndex
) -> tuple[DataFrame, Column]:
    """Nearest candidate, one column per slot so that it is all generated code.

    Candidates are packed in order of id, so the first of equals has the smallest id.
    A cell with more candidates than slots has those of the event's part listed; what the
    list has beyond the slots is searched in an array.
    """
    lon, lat = F.col("lon"), F.col("lat")
    lists = index.widest > index.slots

    def candidate(number: Column) -> Column:
        if not lists:
            return F.get(pack, number)
        listed = F.get("_places", number)
        return F.get(pack, F.when(F.col("_places").isNull(), number).otherwise(listed))

    slots = [f"_slot{i}" for i in range(max(1, min(index.slots, index.widest)))]
    distances = {
        slot: squared_distance(lon, lat, candidate(F.lit(i))) for i, slot in enumerate(slots)
    }
    located = located.withColumns(distances)
    smallest = F.least(*slots) if len(slots) > 1 else F.col(slots[0])
    kept = [pack, "_places"] if lists else [pack]
    located = located.select(*names, *kept, *slots, smallest.alias("_d2"))
    place = F.coalesce(*(F.when(F.col(s) == F.col("_d2"), F.lit(i)) for i, s in enumerate(slots)))
    best = F.struct("_d2", candidate(place)["segment_id"].alias("segment_id"))
    if lists:
        others = F.slice("_places", index.slots + 1, index.widest)
        others = F.transform(others, lambda number: F.get(pack, number))
        more = F.when(F.size("_places") > index.slots, _nearest_of_all(others))
        return located, _in_reach_of(index, F.array_min(F.array(best, more)))
    near = F.col("_d2") <= index.max_dist * index.max_dist
    return located, F.when(near, F.array(best))


def _nearest_of_all(pack: str | Column) -> Column:
    """Nearest candidate of a packed array of any length."""
    steps = F.transform(pack, lambda c: along_segment(F.col("lon"), F.col("lat"), c))
    return F.array_min(
        F.transform(
            steps,
            lambda s: F.struct(offset_squared(s).alias("_d2"), s["segment_id"].alias("segment_id")),
        )
    )


def _build_side(part: DataFrame, small: bool) -> DataFrame:
    """How the index is joined is decided by its measured size, not by an estimate.

    The shuffled form hashes the index: events are divided by cell but not sorted.
    """
    return F.broadcast(part) if small else part.hint("shuffle_hash")


def _locate(events: DataFrame, index: RoadIndex, broadcast_bytes: int) -> DataFrame:
    """Add the cell an event has to look in: the deepest one on the way down.

    Events outside the box get numbers of no cell, spread so that they do not meet in one
    partition.
    """
    u, v = _cell_units(F.col("lon"), F.col("lat"), index.cell_size)
    ok = F.coalesce(inside(F.col("lon"), F.col("lat"), index.box), F.lit(False))
    spread = F.pmod(F.xxhash64(*events.columns), F.lit(1 << 20)).cast("int")
    nowhere = F.lit(NOWHERE) - spread

    def number(steps: Column, depth: int) -> Column:
        # A factor of a power of two is exact: cells of all levels nest.
        return F.when(ok, F.floor(steps * float(SPLIT**depth)).cast("int")).otherwise(nowhere)

    def part(scale: Column) -> Column:
        """Number of the part of its cell in which an event is, as ``_with_places`` counts."""
        dx = F.floor(u * scale * SPLIT) - F.floor(u * scale) * SPLIT
        dy = F.floor(v * scale * SPLIT) - F.floor(v * scale) * SPLIT
        return F.when(ok, (dx * SPLIT + dy).cast("int"))

    if not index.depths:
        parts = {"_part": part(F.lit(1.0))} if index.widest > index.slots else {}
        return events.withColumns({"_ix": number(u, 0), "_iy": number(v, 0), **parts})

    fields = [f"bits{depth}" for depth in range(1, index.depths)]
    tops = index.tops.select(
        F.col("ix").alias("_ix0"), F.col("iy").alias("_iy0"), F.lit(1).alias("_split"), *fields
    )
    events = events.withColumns({"_ix0": number(u, 0), "_iy0": number(v, 0)})
    small = index.split_cells * SPLIT_BYTES <= broadcast_bytes
    events = events.join(_build_side(tops, small), ["_ix0", "_iy0"], "left")
    level = F.coalesce(F.col("_split"), F.lit(0))
    for depth in range(1, index.depths):
        code = _code(number(u, depth), number(v, depth), depth)
        word = F.get(F.col(f"bits{depth}"), F.floor(code / WORD).cast("int"))
        bit = F.call_function("shiftright", word, (code % WORD).cast("int")).bitwiseAND(F.lit(1))
        level = level + F.coalesce(bit, F.lit(0)).cast("int")
    scale = F.pow(F.lit(float(SPLIT)), F.col("_level"))
    parts = {"_part": part(scale)} if index.widest > index.slots else {}
    return events.withColumn("_level", level).withColumns(
        {
            **parts,
            "_ix": F.when(ok, F.floor(u * scale).cast("int")).otherwise(nowhere),
            "_iy": F.when(ok, F.floor(v * scale).cast("int")).otherwise(nowhere),
        }
    )


def _cell_units(lon: Column, lat: Column, size: float) -> tuple[Column, Column]:
    return lon * LON_SCALE / size, lat / F.lit(size)


def _near_box(segments: DataFrame, box: Box, max_dist: float) -> DataFrame:
    """Segments that may reach the box; plain comparisons that a Parquet scan can use."""
    lon_reach, lat_reach = 2 * max_dist / LON_SCALE, 2 * max_dist
    x1, y1, x2, y2 = (F.col(name) for name in ("x1", "y1", "x2", "y2"))
    finite = F.lit(True)
    for value, limit in ((x1, 360.0), (x2, 360.0), (y1, 90.0), (y2, 90.0)):
        finite = finite & value.between(-limit, limit)
    return segments.where(
        finite
        & F.col("segment_id").isNotNull()
        & ((x1 > box.west - lon_reach) | (x2 > box.west - lon_reach))
        & ((x1 < box.east + lon_reach) | (x2 < box.east + lon_reach))
        & ((y1 > box.south - lat_reach) | (y2 > box.south - lat_reach))
        & ((y1 < box.north + lat_reach) | (y2 < box.north + lat_reach))
    )


def _distinct_shapes(segments: DataFrame) -> DataFrame:
    """Of segments with the same ends only the smallest id can be a match."""
    return segments.groupBy("x1", "y1", "x2", "y2").agg(F.min("segment_id").alias("segment_id"))


def _spread(segments: DataFrame, size: float, max_dist: float, box: Box) -> DataFrame:
    """One row per segment and cell in its reach, column by column of the lookup grid."""
    reach = max_dist / size + SLACK
    u1, v1 = _cell_units(F.col("x1"), F.col("y1"), size)
    u2, v2 = _cell_units(F.col("x2"), F.col("y2"), size)
    west, south = box.west * LON_SCALE / size - 1, box.south / size - 1
    east, north = box.east * LON_SCALE / size + 1, box.north / size + 1

    shaped = segments.select(
        "segment_id",
        F.struct(*segment_shape(*(F.col(c) for c in ("x1", "y1", "x2", "y2")))).alias("shape"),
        u1.alias("u1"), v1.alias("v1"), u2.alias("u2"), v2.alias("v2"),
    )
    u1, v1, u2, v2 = (F.col(name) for name in ("u1", "v1", "u2", "v2"))
    columns = shaped.select(
        "*", F.explode(_cells_between(F.least(u1, u2), F.greatest(u1, u2), reach, west, east)).alias("ix")
    )
    # The part of the segment near this column of cells.
    run = F.when(u1 == u2, F.lit(None)).otherwise(u2 - u1)
    enter = (F.col("ix") - reach - u1) / run
    leave = (F.col("ix") + 1 + reach - u1) / run
    start = F.coalesce(_unit(F.least(enter, leave)), F.lit(0.0))
    stop = F.coalesce(_unit(F.greatest(enter, leave)), F.lit(1.0))
    columns = columns.withColumns({"va": v1 + (v2 - v1) * start, "vb": v1 + (v2 - v1) * stop})
    low, high = F.least("va", "vb"), F.greatest("va", "vb")
    cells = columns.select(
        "segment_id",
        "shape",
        "ix",
        F.explode(_cells_between(low, high, reach + SLACK, south, north)).alias("iy"),
    )
    return _in_reach(cells, size, max_dist)


def _cells_between(low: Column, high: Column, reach: float, first: float, last: float) -> Column:
    start = F.floor(F.greatest(low - reach, F.lit(first))).cast("int")
    stop = F.floor(F.least(high + reach, F.lit(last))).cast("int")
    return F.when(start <= stop, F.sequence(start, stop))


def _unit(value: Column) -> Column:
    # greatest and least skip NULLs, and NULL has to stay NULL here.
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def _in_reach(cells: DataFrame, size: float, max_dist: float) -> DataFrame:
    """Cells of a segment that may hold points in its reach: the distance of the cell's middle,
    less half a diagonal, is within it."""
    lon = (F.col("ix") + 0.5) * (size / LON_SCALE)
    lat = (F.col("iy") + 0.5) * size
    half = size * (math.sqrt(0.5) + SLACK)
    middle = F.sqrt(squared_distance(lon, lat, F.col("shape")))
    return keep_if(cells.withColumn("_mid", middle), F.col("_mid") - half <= max_dist, cells.columns)


def _divide(marked: DataFrame) -> DataFrame:
    """The parts of each crowded cell, each with the segments that can be nearest there."""
    steps = range(SPLIT)
    parts = F.array(
        *(
            F.when(
                F.col("parts").bitwiseAND(F.lit(1 << (dx * SPLIT + dy))) != 0,
                F.struct(
                    (F.col("ix") * SPLIT + dx).alias("_ix"), (F.col("iy") * SPLIT + dy).alias("_iy")
                ),
            )
            for dx in steps
            for dy in steps
        )
    )
    cells = marked.select("segment_id", "shape", F.inline(F.array_compact(parts)))
    return cells.withColumnsRenamed({"_ix": "ix", "_iy": "iy"})


def _mark_parts(
    level: DataFrame, crowded: DataFrame, few: bool, size: float, max_dist: float
) -> DataFrame:
    """The entries of the ``crowded`` cells with ``parts``: a bit field of those parts, of
    ``size``, of their cell where the segment can be nearest. Entries without one are dropped.

    A segment can be nearest in a part if its distance from the middle is at most that of the
    nearest one and a diagonal, and the reach and half a diagonal.
    """
    half = size * (math.sqrt(0.5) + SLACK)
    cells = level.join(_build_side(crowded, few), ["ix", "iy"])
    cells = cells.select("ix", "iy", "segment_id", "shape", *_part_steps(size))
    far, cells = _part_distances(cells, ["ix", "iy", "segment_id", "shape"], size)
    reach = [
        F.pow(F.least(F.sqrt(F.min(name)) + 2 * half, F.lit(half + max_dist)), 2).alias(f"_most{name}")
        for name in far
    ]
    most = materialize(cells.groupBy("ix", "iy").agg(*reach), "road-cell-reach")
    few = most.count() * (SPLIT_BYTES + 8 * len(far)) <= BROADCAST_BYTES
    joined = cells.join(_build_side(most, few), ["ix", "iy"])
    tests = [F.col(name) <= F.col(f"_most{name}") for name in far]
    parts = reduce(Column.bitwiseOR, (F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)))
    marked = joined.select("ix", "iy", "segment_id", "shape", parts.alias("parts"))
    return keep_if(marked, F.col("parts") != 0, marked.columns)


def _part_steps(size: float) -> list[Column]:
    """What the distances of a segment from the middles of all parts of a cell share. The
    columns are never null, which makes for short code: Java does not compile long methods."""
    x1, y1, dx, dy, len2 = (F.col(f"shape.{name}") for name in ("x1", "y1", "dx", "dy", "len2"))
    px = F.col("ix") * (SPLIT * size) - x1 * LON_SCALE
    py = F.col("iy") * (SPLIT * size) - y1
    columns = {"_px": px, "_py": py, "_dx": dx, "_dy": dy, "_ax": dx / len2, "_ay": dy / len2}
    return [F.coalesce(value, F.lit(0.0)).alias(name) for name, value in columns.items()]


def _part_distances(
    cells: DataFrame, names: list[str], size: float
) -> tuple[list[str], DataFrame]:
    """Columns of the squared distances from the middles of the parts, in the order of their
    numbers."""
    steps = [(step + 0.5) * size for step in range(SPLIT)]
    xs = {f"_x{i}": F.col("_px") + step for i, step in enumerate(steps)}
    ys = {f"_y{i}": F.col("_py") + step for i, step in enumerate(steps)}
    shared = {"_dx", "_dy", "_ax", "_ay"}
    cells = cells.select(*names, *sorted(shared), *(c.alias(n) for n, c in (xs | ys).items()))
    ax = {f"_a{x}": F.col(x) * F.col("_ax") for x in xs}
    ay = {f"_a{y}": F.col(y) * F.col("_ay") for y in ys}
    cells = cells.select("*", *(c.alias(n) for n, c in (ax | ay).items()))
    along = {f"_t{x}{y}": F.col(f"_a{x}") + F.col(f"_a{y}") for x in xs for y in ys}
    cells = cells.select("*", *(_within(c).alias(n) for n, c in along.items()))
    far = {}
    for x in xs:
        for y in ys:
            t = F.col(f"_t{x}{y}")
            ex, ey = F.col(x) - t * F.col("_dx"), F.col(y) - t * F.col("_dy")
            far[f"_far{x}{y}"] = ex * ex + ey * ey
    return list(far), cells.select(*names, *(d2.alias(name) for name, d2 in far.items()))


def _within(along: Column) -> Column:
    return F.when(along < 0.0, 0.0).when(along > 1.0, 1.0).otherwise(along)


def _leaf(entries: DataFrame, depth: int) -> DataFrame:
    parts = F.col("parts") if "parts" in entries.columns else F.lit(-1)
    columns = ["ix", "iy", "segment_id", "shape", parts.alias("parts")]
    return entries.select(F.lit(depth).alias("level"), *columns)


def _pack(leaves: DataFrame) -> DataFrame:
    candidate = F.struct("segment_id", "shape.*", "parts")
    packed = F.sort_array(F.collect_list(candidate))
    return leaves.groupBy(*CELL).agg(packed.alias("candidates"))


def _with_places(cells: DataFrame, slots: int) -> DataFrame:
    """Add ``places`` to cells with more candidates than slots: for each of their parts the
    places of the candidates that can be nearest there, in order. The shapes are kept once
    for all parts."""

    def listed(part: Column) -> Column:
        bits = F.col("candidates.parts")
        every = F.transform(bits, lambda b, i: F.when(b.bitwiseAND(part) != 0, i))
        return F.array_compact(every)

    masks = F.array(*(F.lit(1 << part) for part in range(SPLIT * SPLIT)))
    crowded = F.size("candidates") > slots
    return cells.select(*CELL, "candidates", F.when(crowded, F.transform(masks, listed)).alias("places"))
