"""Operator 7: near-duplicates by SimHash with pigeonhole blocks.

The fingerprint of a text is the bitwise majority of the 64-bit hashes of its word
shingles. Texts of one fingerprint are a class; only different fingerprints are compared.

A fingerprint is split into ``BLOCKS`` blocks. Two that differ in at most ``DISTANCE`` bits
agree in all blocks but ``DISTANCE``, so they meet in the bucket of at least one choice of
``BLOCKS - DISTANCE`` blocks (about 38 of 64 bits for a choice of 3 of 5). Buckets are
joined with themselves and each pair is verified by its Hamming distance, once, in the
first bucket it shares.

A bucket of over ``CROWD`` fingerprints, as very large groups of near copies make, is not
paired. There each fingerprint is listed under itself and under every neighbour one bit
away within the blocks that the bucket leaves free. Two fingerprints share a listed value
just when they differ in at most two bits, so a chain along each value links all of them:
exact, and linear in the size of the bucket.

Components are found by repeated star contraction over stored tables.

Null and wordless texts have fingerprint zero and are linked like others. Repeated rows
are members of one class. A row without an id is fingerprinted and joins its class; its
component is the smallest id there, or null if the whole component has none. Other columns
are not read. An empty table gives an empty result.

The stage of the pipeline, ``keep_one``, keeps one row of each component.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices
from roadpulse.session import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = 5
CROWD = 64
LARGE = 10_000
UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(UPPER, UPPER.lower())


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """Majority of the hashes of the word shingles of a UTF-8 text, as a signed number."""
    parts = text.translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return _signed(xxhash.xxh64_intdigest(joined, SEED))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    shingles = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    hashes = np.array(shingles, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(
            hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << place for place in np.flatnonzero(2 * ones > len(hashes)).tolist())
    return _signed(value)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp`` (signed 64 bits) of each row. One pass, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for rows, texts in text_slices(batches):
            data = texts.cast(pa.binary())
            values = [fingerprint(text) for text in data.to_pylist()]
            yield pa.record_batch({"id": rows.column("id"), "fp": pa.array(values, pa.int64())})

    return slim.mapInArrow(run, f"id {kind}, fp bigint")


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Masks of all choices of ``blocks - distance`` blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(choice) for choice in combinations(parts, blocks - distance)]


def close_links(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links ``a``, ``b`` that connect all of the distinct ``fp`` within ``distance`` bits.

    In uncrowded buckets every close pair is a link; in crowded ones links are chains whose
    ends are within ``distance`` of each other, with the same connections.
    """
    if distance > 2:
        raise ValueError("crowded buckets are divided exactly for distances up to 2 only")
    masks = block_masks(BLOCKS, distance)
    spark = prints.sparkSession
    numbered = [(number, _signed(mask)) for number, mask in enumerate(masks)]
    keys = F.explode(
        F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("mask")) for n, m in numbered])
    )
    listed = prints.select("fp", keys.alias("k")).select(
        "fp", F.col("k.n").alias("n"), F.col("fp").bitwiseAND(F.col("k.mask")).alias("bucket")
    )
    sizes = listed.groupBy("n", "bucket").agg(F.count(F.lit(1)).alias("size"))
    shared = materialize(
        listed.join(sizes.where("size > 1"), ["n", "bucket"]).select("fp", "n", "bucket", "size"),
        "simhash-buckets",
    )
    few = shared.where(F.col("size") <= crowd).select("fp", "n", "bucket")
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    unlike = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(len(masks))
    for number, mask in reversed(numbered):
        first = F.when(unlike.bitwiseAND(F.lit(mask)) == 0, F.lit(number)).otherwise(first)
    pairs = left.join(right, ["n", "bucket"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(unlike) <= distance) & (first == F.col("n"))
    )
    # Crowded buckets: own value and each one-bit neighbour in the free blocks.
    free = [
        F.lit(_signed(1 << bit)) for bit in range(64)
    ]
    crowded = shared.where(F.col("size") > crowd)
    mask_of = F.element_at(F.array(*[F.lit(m) for _, m in numbered]), F.col("n") + 1)
    flips = F.filter(F.array(F.lit(0).cast("bigint"), *free), lambda bit: bit.bitwiseAND(mask_of) == 0)
    near = crowded.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")
    ).distinct()
    along = Window.partitionBy("value").orderBy("fp")
    chains = near.select(F.lag("fp").over(along).alias("a"), F.col("fp").alias("b"))
    return pairs.select("a", "b").union(chains.where(F.col("a").isNotNull())).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (least member) of every node that has a link.

    Star contraction: each node's larger neighbours, then its smaller ones, are linked to
    the least of them, until every link points at a root. Rounds are stored tables.
    """
    star = materialize(links.select(F.col("b").alias("u"), F.col("a").alias("v")), "links")
    for _ in range(most_rounds):
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        after = materialize(small, "small-star")
        if _same(star, after):
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        star = after
    raise RuntimeError("components did not settle")


def _same(before: DataFrame, after: DataFrame) -> bool:
    """Whether two sets of links agree, by counts and sums of hashes."""

    def digest(rows: DataFrame):
        hashes = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(rows.agg(F.count(F.lit(1)), F.sum(hashes)).first())

    return digest(before) == digest(after)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(
    docs: DataFrame, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row."""
    prints = materialize(with_fingerprints(docs, id_col, text_col), "fingerprints")
    sizes = prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = materialize(sizes, "classes")
    rooted = components(close_links(classes.select("fp"), distance))
    roots = rooted.select(F.col("node").alias("fp"), "root").union(
        rooted.select(F.col("root").alias("fp"), "root")
    )
    # Only linked classes; a class of its own is its least id.
    members = classes.join(roots.distinct(), "fp")
    named = members.groupBy("root").agg(F.min("least").alias("component"))
    linked = members.join(named, "root").select("fp", "component")
    labels = classes.join(linked, "fp", "left").select(
        "fp", "n", F.coalesce("component", "least").alias("component_id")
    )
    labels = materialize(labels, "labels")
    # Classes of more than one in LARGE rows are fewer than LARGE: a bounded broadcast, so
    # no task gets the rows of a large class together.
    rows = prints.count()
    large = F.broadcast(labels.where(F.col("n") * LARGE > rows).drop("n"))
    in_large = prints.join(large, "fp")
    in_small = prints.join(large.select("fp"), "fp", "left_anti").join(labels.drop("n"), "fp")
    return in_large.unionByName(in_small).select(
        F.col("id").alias(id_col), hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


# --- the stage of the pipeline -------------------------------------------------------


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that of the smallest
    ``doc_id``, of several with that id the one of the smallest hash of the text; of equal
    rows one.

    Links are those of ``near_duplicates`` with its shingles and distance. A row is named by
    its id and a hash of its text, so rows that share an id are judged each on its own. A row
    without an id stays only where its component has none with an id. Null, empty and
    wordless texts have fingerprint zero and are one component: one of them stays. Texts do
    not move: what is dropped is found by name, and Spark broadcasts the names only below
    its own limit of size. An empty table gives an empty result.
    """
    text = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text.alias("text"))
    slim = docs.select(name.alias("_name"), "text")
    found = near_duplicates(slim, id_col="_name")
    found = materialize(found.select("_name", "component_id"), "components-of-rows")
    stays = F.col("_name") == F.col("component_id")
    # Stored, so that Spark knows their size when it plans the join.
    dropped = materialize(found.where(~stays).select("_name").distinct(), "dropped-rows")
    repeated = found.where(stays).groupBy("_name").count().where("count > 1").select("_name")
    kept = docs.withColumn("_name", name).join(dropped, "_name", "left_anti")
    if repeated.limit(1).count():
        once = kept.join(repeated, "_name", "left_semi").dropDuplicates(["_name"])
        kept = kept.join(repeated, "_name", "left_anti").unionByName(once)
    return kept.select(*docs.columns)
