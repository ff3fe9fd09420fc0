"""Operator 3: sharding by sampled splitters.

Records are placed in the order of a hash of their text, so equal texts lie together.
A bounded sample of keys, drawn with chances by size, gives splitters at its quantiles;
the records are counted in the ranges between them. A range that holds over ``OVERFULL``
times its share, as a text with very many copies does, is sampled again and subdivided,
now by a hash of the id as well. Neighbouring ranges then form shards of nearly equal
size in bytes. There are ``RANGES_PER_SHARD`` ranges for each shard, so shards differ by
about one such range. Equal texts share a shard unless they had to be subdivided.

Slots count the records of a shard in key order without gaps: the rank within the range
after the ranges before it. No text is shuffled.

Size is the bytes of the text plus 1; a null text has size 1 and the checksum of an empty
one. Repeated rows and null ids are placed like others. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import materialize

SHARDS = 8
RANGES_PER_SHARD = 128
SAMPLE = 40_000
OVERFULL = 2.0
LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Splitters:
    """Lower ends (key, tie) of all ranges but the first, ascending."""

    keys: np.ndarray
    ties: np.ndarray

    def place(self, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.keys, key, "left")
        high = np.searchsorted(self.keys, key, "right")
        found = low.copy()
        met = np.flatnonzero(high > low)
        for value in np.unique(key[met]):
            rows = met[key[met] == value]
            a, b = low[rows[0]], high[rows[0]]
            found[rows] = a + np.searchsorted(self.ties[a:b], tie[rows], "right")
        return found


def _with_range(records: DataFrame, splitters: Splitters) -> DataFrame:
    @F.pandas_udf("int")
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(splitters.place(key.to_numpy(), tie.to_numpy()).astype(np.int32))

    return records.withColumn("range", place("key", "tie"))


def _sample(records: DataFrame, count: int, total: int) -> pd.DataFrame:
    """About ``count`` keys drawn with chances by size: those whose exponential variate of
    rate ``size`` is at most ``count / total``. The variates are made from a hash, so a rerun
    agrees, and each task sends only what is drawn."""
    uniform = (F.xxhash64("key", "tie", F.lit("draw")).cast("double") + 2.0**63) / 2.0**64
    arrival = -F.log(F.greatest(uniform, F.lit(2.0**-64))) / F.col("size")
    return records.where(arrival <= count / total).select("key", "tie").toPandas()


def _quantiles(sample: pd.DataFrame, parts: int, by_tie: bool) -> list[tuple[int, int]]:
    if sample.empty:
        return []
    sample = sample.sort_values(["key", "tie"])
    at = (np.arange(1, parts) * len(sample)) // parts
    keys = sample["key"].to_numpy()[at].tolist()
    ties = sample["tie"].to_numpy()[at].tolist() if by_tie else [LOWEST] * len(keys)
    return list(zip(keys, ties))


def _splitters(points: set[tuple[int, int]]) -> Splitters:
    ordered = sorted(points)
    return Splitters(
        np.array([key for key, _ in ordered], np.int64), np.array([tie for _, tie in ordered], np.int64)
    )


def find_splitters(
    records: DataFrame, ranges: int, sample: int = SAMPLE, rounds: int = 4
) -> tuple[Splitters, dict[int, tuple[int, int]]]:
    """Splitters, and the size and rows of each range. The driver gets the sample, of about
    ``sample`` keys, and one row for each range."""
    total = records.agg(F.sum("size")).first()[0]
    if total is None:
        return _splitters(set()), {}
    drawn = _sample(records, sample, total)
    points = set(_quantiles(drawn, ranges, by_tie=False))
    for round_ in range(rounds + 1):
        splitters = _splitters(points)
        placed = _with_range(records, splitters)
        sums = placed.groupBy("range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        held = {row["range"]: (row["size"], row["n"]) for row in sums.collect()}
        share = sum(size for size, _ in held.values()) / ranges
        overfull = {r: size for r, (size, n) in held.items() if size > OVERFULL * share and n > 1}
        if not overfull or round_ == rounds:
            break
        inside = placed.where(F.col("range").isin(list(overfull)))
        again = _sample(inside, sample, sum(overfull.values()))
        place = splitters.place(again["key"].to_numpy(), again["tie"].to_numpy())
        before = len(points)
        for number, size in overfull.items():
            parts = int(np.ceil(size / share))
            points.update(_quantiles(again[place == number], parts, by_tie=True))
        if len(points) == before:
            break
    return splitters, held


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    ranges_per_shard: int = RANGES_PER_SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    records = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.xxhash64(F.col(id_col), F.lit("tie")).alias("tie"),
    )
    records = materialize(records, "shard-records")
    splitters, held = find_splitters(records, shards * ranges_per_shard)
    total = sum(size for size, _ in held.values())
    table, size_before, slots = [], 0, {}
    for number in sorted(held):
        size, rows = held[number]
        shard = min(shards - 1, int((size_before + size / 2) * shards / total))
        table.append((number, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + rows
        size_before += size
    # One row for each range: bounded by the parameters.
    spark = docs.sparkSession
    ranges = F.broadcast(spark.createDataFrame(table, "range int, shard int, _before long"))
    order = Window.partitionBy("range").orderBy("key", "tie", "id", "size", "text_crc32")
    numbered = _with_range(records, splitters).withColumn("_rank", F.row_number().over(order) - 1)
    return numbered.join(ranges, "range").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("_before") + F.col("_rank")).cast("bigint").alias("slot"),
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder for each shard of a table with ``shard`` and ``slot``, in slot order."""
    parts = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    parts.write.partitionBy("shard").parquet(path)
