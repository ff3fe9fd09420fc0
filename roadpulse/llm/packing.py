"""Operator 8: best-fit packing by patterns fitted with non-negative least squares.

Texts become pieces of at most ``capacity`` tokens. Only the histogram of piece lengths
(at most ``capacity`` numbers, whatever the size of the corpus) goes to the driver:

1. Patterns of up to ``PATTERN_DOCS`` length classes that fill a sequence are enumerated,
   and repeat counts are fitted to the histogram by non-negative least squares.
2. Counts are rounded down. A repeated pattern takes exact lengths of its classes; its
   last place takes the longest piece that fits.
3. The rest is packed longest first into the fullest open sequence that has room.

The resulting plan is a bounded table of runs: "from the k-th piece of this length on, so
many pieces go to these sequences at this offset". Pieces are numbered within their length
by counts of salted groups, so a length that a third of all pieces share is divided.

Null text is the empty text (one piece, the end id). Repeated rows are packed once for
each row. Null ids are packed as well. Other columns are not read. An empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices
from roadpulse.llm.tokens import CACHE, encoder
from roadpulse.session import materialize

CAPACITY = 2048
CLASSES = 128
PATTERN_DOCS = 4
SALTS = 64


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
    cache_limit: int = CACHE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of each row: id, ``piece``, ``start``, ``length``, ``ids_crc32``, and with
    ``with_ids`` the ``ids`` (binary, unsigned 32-bit little-endian).

    A document of more than ``capacity`` ids is cut so that only its first piece is
    shorter.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        model = encoder(tokenizer_path, cache_limit)
        for rows, texts in text_slices(batches):
            ids, counts = model.encode(texts)
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = counts - (pieces - 1) * capacity
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[row], capacity)
            begins = (np.cumsum(counts) - counts)[row] + start
            data = memoryview(ids.tobytes())
            spans = [data[4 * a : 4 * (a + n)] for a, n in zip(begins.tolist(), length.tolist())]
            columns = {
                "id": rows.column("id").take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(span) for span in spans], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([bytes(span) for span in spans], pa.binary())
            yield pa.record_batch(columns)

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    made = slim.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
    return made.withColumnRenamed("id", id_col)


def patterns(total: int, most: int) -> list[tuple[int, ...]]:
    """Ways to write ``total`` as at most ``most`` positive numbers, largest first."""
    found = []

    def extend(head, left, top):
        if left == 0:
            found.append(head)
        elif len(head) < most:
            least = -(-left // (most - len(head)))
            for part in range(min(left, top), least - 1, -1):
                extend((*head, part), left - part, part)

    extend((), total, total)
    return found


def nonnegative_fit(ways: list[tuple[int, ...]], target: np.ndarray) -> np.ndarray:
    """Repeat counts of patterns (tuples of places in ``target``) by active-set
    non-negative least squares."""
    most = max(map(len, ways))
    blank = len(target)
    places = np.array([way + (blank,) * (most - len(way)) for way in ways])
    fitted, active = np.zeros(len(ways)), np.zeros(len(ways), bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0.0)))

    def columns(chosen: np.ndarray) -> np.ndarray:
        matrix = np.zeros((blank + 1, len(chosen)))
        for place in places[chosen].T:
            matrix[place, np.arange(len(chosen))] += 1
        return matrix[:blank]

    left = np.append(target, 0.0)
    for _ in range(6 * blank):
        gradient = left[places].sum(axis=1)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while active.any():
            chosen = np.flatnonzero(active)
            matrix = columns(chosen)
            values = np.linalg.lstsq(matrix, target, rcond=None)[0]
            if values.min() > tolerance:
                fitted[:] = 0
                fitted[chosen] = values
                left[:blank] = target - matrix @ values
                break
            now = fitted[chosen]
            falling = values <= tolerance
            step = float(np.min(now[falling] / np.maximum(now[falling] - values[falling], 1e-300)))
            fitted[chosen] = now + min(1.0, step) * (values - now)
            gone = chosen[falling & (fitted[chosen] <= tolerance)]
            if len(gone) == 0:
                gone = chosen[[int(np.argmin(values))]]
            fitted[gone] = 0
            active[gone] = False
    return fitted


def plan_packing(
    histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES
) -> list[tuple[tuple[int, ...], int]]:
    """Runs of equal sequences: the lengths in one, and how many such sequences.

    The work depends on the number of different lengths, not on the number of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] += count
    runs: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        runs.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    width = -(-capacity // classes)
    steps = -(-capacity // width)
    of_class = np.bincount(-(-np.arange(capacity + 1) // width), left, steps + 1)[1:]
    ways = [
        way for way in patterns(steps, PATTERN_DOCS) if all(of_class[part - 1] for part in way)
    ]
    if ways:
        fitted = nonnegative_fit([tuple(part - 1 for part in way) for way in ways], of_class)
        repeats = np.floor(fitted + 1e-6).astype(np.int64)
        for column in np.argsort(-repeats, kind="stable"):
            if repeats[column] == 0:
                break
            runs += _take(ways[column], int(repeats[column]), left, width, capacity)
    return _pack_rest(runs, left, capacity)


def _take(way, repeats, left, width, capacity):
    """Exact lengths for a repeated pattern."""
    runs = []
    while repeats:
        chosen, room = [], capacity
        for place, part in enumerate(way):
            low = (part - 1) * width + 1
            high = room if place == len(way) - 1 else min(part * width, room)
            free = left[low : high + 1].copy()
            for length in chosen:
                if low <= length <= high:
                    free[length - low] -= 1
            there = np.flatnonzero(free > 0)
            if len(there) == 0:
                return runs
            chosen.append(int(low + there[-1]))
            room -= chosen[-1]
        lengths, uses = np.unique(chosen, return_counts=True)
        count = min(repeats, int(np.min(left[lengths] // uses)))
        left[lengths] -= uses * count
        runs.append((tuple(chosen), count))
        repeats -= count
    return runs


def _pack_rest(runs, left, capacity):
    """Longest first, each into the open sequences with the least sufficient room."""
    done, open_runs, rooms = [], {}, []

    def put(lengths, count):
        room = capacity - sum(lengths)
        if room == 0:
            done.append((lengths, count))
            return
        if room not in open_runs:
            open_runs[room] = []
            insort(rooms, room)
        open_runs[room].append((lengths, count))

    for lengths, count in runs:
        put(lengths, count)
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                break
            room = rooms[at]
            lengths, there = open_runs[room].pop()
            used = min(count, there)
            if there > used:
                open_runs[room].append((lengths, there - used))
            if not open_runs[room]:
                del open_runs[room], rooms[at]
            put((*lengths, length), used)
            count -= used
        each = capacity // length
        if count >= each:
            put((length,) * each, count // each)
        if count % each:
            put((length,) * (count % each), 1)
    return done + [run for room in rooms for run in open_runs[room]]


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")
) -> DataFrame:
    """``pieces`` (with ``length``) and the ``sequence_id`` and ``offset`` of each.

    ``pieces`` should be a stored table: it is read three times. ``order`` numbers pieces
    of one length; rows that agree in it are interchangeable.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").count().collect()
    runs = plan_packing({row["length"]: row["count"] for row in counts}, capacity)
    slots, seen, sequence = [], {}, 0
    for lengths, count in runs:
        offset = 0
        for length in lengths:
            first = seen.get(length, 0)
            slots.append((length, first, first + count, sequence, offset))
            seen[length] = first + count
            offset += length
        sequence += count
    plan = spark.createDataFrame(
        slots, "_length long, _first long, _stop long, _sequence long, offset long"
    )
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    groups = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("length", "_salt").orderBy(*order)
    numbered = salted.withColumn("_k", F.row_number().over(within) - 1)
    numbered = numbered.join(groups, ["length", "_salt"])
    place = F.col("_k") + F.col("_base")
    # The plan has a few runs for each of at most ``capacity`` lengths: a bounded broadcast.
    placed = numbered.join(
        F.broadcast(plan),
        (F.col("length") == F.col("_length")) & (place >= F.col("_first")) & (place < F.col("_stop")),
    )
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + place - F.col("_first")).alias("sequence_id"),
        "offset",
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    cache_limit: int = CACHE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their sequences. ``cache_limit`` bounds the chunks whose
    ids a worker keeps; it trades memory for speed."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = token_pieces(slim, tokenizer_path, capacity, cache_limit=cache_limit)
    pieces = materialize(made, "pieces")
    packed = pack(pieces, capacity, ("doc_id", "piece", "ids_crc32"))
    return packed.withColumnRenamed("doc_id", id_col)
