"""A corpus from raw documents to packed sequences.

Each stage applies one operator to all rows that the stage before it kept. The first four
return rows of ``documents`` unchanged, the last one the pieces and their sequences. What
nulls, empty and very long texts, ties, repeated rows and empty tables give is said at each
stage; columns beside those of ``documents`` are carried along until the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import decontaminate, language_id, packing, quality, simhash
from roadpulse.session import materialize

# Less than the default: workers that other stages have used still hold memory.
PACKING_CACHE = 100_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known go on. Null, empty and letterless texts have none and
    go; equal rows are judged alike; if no language can be learned, nothing goes on."""
    return language_id.keep_identified(docs)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality go on, a score on the limit included. Null texts are judged as
    empty ones; equal rows are judged alike; without labels of both classes all go on."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates goes on, that of the smallest id; of equal
    rows one. Groups are those of operator 7 with its shingles and bit distance. Null, empty and
    wordless texts are one group; a row without an id goes on only where its group has no id."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item go on. Null and empty texts hold none; documents without an
    id go on; rows that share an id go together."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens. A null or empty text is one piece
    with the end id; equal rows are packed once for each; a long text is cut into pieces."""
    file = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, file, cache_limit=PACKING_CACHE)


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# Language models, trained classifiers and tokenizers have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is stored and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
