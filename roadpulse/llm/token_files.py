"""Operator 5: token ids in files of directly addressable codes.

An id is split into bytes. Level 0 holds the lowest byte of every id, level 1 the next
byte of those that go on, and so forth. Each level has a bitmap that says which of its
entries go on, and a directory of the ones before every 512th bit: the place of an entry
in the next level is the rank of its bit, so any token is read without decoding others.

A code book covers whole documents of a stretch of the order (``SEGMENT_IDS`` ids or more;
a longer document is one of its own). The files are Parquet folders with one row for each
book: its partition and number there, its documents with their places, and the codes.

Order: ``doc_id`` ascending, nulls first, then by a hash of the text, so repeated ids
are no hot range. Null text is the empty text (the end id alone). Other columns are not
read. An empty table writes an empty folder.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices
from roadpulse.llm.tokens import encoder

MAGIC = b"DAC1"
STRIDE = 512
SEGMENT_IDS = 1 << 20


def encode_codes(ids: np.ndarray) -> bytes:
    """Ids below 2^32 as one code book."""
    rest = np.asarray(ids, np.uint32)
    levels = []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), STRIDE)) if len(more) else np.zeros(0)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        levels.append(((rest & 255).astype(np.uint8), bits, ranks))
        rest = rest[more] >> 8
        if len(rest) == 0:
            break
    parts = [MAGIC, struct.pack("<I", len(levels))]
    for chunk, bits, ranks in levels:
        parts += [struct.pack("<Q", len(chunk)), chunk.tobytes(), bits.tobytes(), ranks.tobytes()]
    return b"".join(parts)


class CodeBook:
    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a code book")
        (count,) = struct.unpack_from("<I", data, 4)
        at, self.levels = 8, []
        for _ in range(count):
            (size,) = struct.unpack_from("<Q", data, at)
            chunk = np.frombuffer(data, np.uint8, size, at + 8)
            bits = np.frombuffer(data, np.uint8, -(-size // 8), at + 8 + size)
            at += 8 + size + len(bits)
            ranks = np.frombuffer(data, "<u4", -(-size // STRIDE), at)
            at += ranks.nbytes
            self.levels.append((chunk, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def rank(self, level: int, place: int) -> int:
        """How many entries before ``place`` go on to the next level."""
        chunk, bits, ranks = self.levels[level]
        if place >= len(chunk):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        block = place // STRIDE
        ones = int(np.bitwise_count(bits[block * STRIDE // 8 : place // 8]).sum())
        tail = int(bits[place // 8]) & ((1 << place % 8) - 1)
        return int(ranks[block]) + ones + tail.bit_count()

    def token(self, place: int) -> int:
        """The id at ``place``."""
        value, level = 0, 0
        while True:
            chunk, bits, _ = self.levels[level]
            value |= int(chunk[place]) << (8 * level)
            if not int(bits[place // 8]) >> (place % 8) & 1:
                return value
            place, level = self.rank(level, place), level + 1

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``."""
        ids = np.zeros(stop - start, np.uint32)
        owners = np.arange(stop - start)
        for level, (chunk, bits, _) in enumerate(self.levels):
            if start >= stop:
                break
            ids[owners] |= chunk[start:stop].astype(np.uint32) << np.uint32(8 * level)
            first = start // 8
            more = np.unpackbits(bits[first : -(-stop // 8)], bitorder="little")
            more = more[start - 8 * first : stop - 8 * first].astype(bool)
            owners = owners[more]
            start = self.rank(level, start)
            stop = start + len(owners)
        return ids


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 1,
    partitions: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode whole texts with the tokenizers library, append ``end_id``, write in order.

    One shuffle by ranges of the order; encoding follows it in the sorted partitions.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    ordered = slim.repartitionByRange(count, *order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        model, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        names, sizes, held, total, seq, before = [], [], [], 0, 0, 0
        id_type = None

        def book():
            ids = np.concatenate(held)
            ends = np.cumsum(sizes, dtype=np.int64)
            return pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "seq": pa.array([seq], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "docs": pa.array([names], pa.list_(id_type)),
                    "ends": pa.array([ends.tolist()], pa.list_(pa.int64())),
                    "codes": pa.array([encode_codes(ids)], pa.binary()),
                }
            )

        for rows, texts in text_slices(batches):
            id_type = rows.column("id").type
            ids, counts = model.encode(texts)
            ends = np.cumsum(counts)
            held.append(np.insert(ids, ends, end_id))
            sizes.extend((counts + 1).tolist())
            names.extend(rows.column("id").to_pylist())
            total += len(held[-1])
            if total >= SEGMENT_IDS:
                yield book()
                seq, before = seq + 1, before + total
                names, sizes, held, total = [], [], [], 0
        if names:
            yield book()

    schema = (
        f"part int, seq int, before bigint, n_ids bigint, docs array<{kind}>,"
        " ends array<bigint>, codes binary"
    )
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``start`` (ids of all documents before it) and ``ids`` (binary, unsigned
    32-bit little-endian) of each document.

    What the driver gathers is one number for each written partition.
    """
    books = spark.read.parquet(path)
    totals = books.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    starts, at = {}, 0
    for row in sorted(totals, key=lambda row: row["part"]):
        starts[row["part"]] = at
        at += row["n"]
    kind = books.schema["docs"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                book = CodeBook(batch.column("codes")[row].as_py())
                ends = np.array(batch.column("ends")[row].as_py(), np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                first = starts[batch.column("part")[row].as_py()] + batch.column("before")[row].as_py()
                spans = [book.span(a, b).astype("<u4").tobytes() for a, b in zip(begins, ends)]
                yield pa.record_batch(
                    {
                        "id": batch.column("docs")[row].values,
                        "start": pa.array(begins + first),
                        "ids": pa.array(spans, pa.binary()),
                    }
                )

    slim = books.select("part", "before", "docs", "ends", "codes")
    found = slim.mapInArrow(run, f"id {kind}, start bigint, ids binary")
    return found.withColumnRenamed("id", id_col)
