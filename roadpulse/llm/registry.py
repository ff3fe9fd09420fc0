"""Queries of this subpackage: each operator with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import (
    conversations,
    decontaminate,
    hard_negatives,
    language_id,
    language_model,
    packing,
    quality,
    sharding,
    simhash,
    token_counts,
    token_files,
    topk,
    url_filter,
)
from roadpulse.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_rare_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents and what was found in each."""
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    file = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, file)
    ids = token_files.read_token_files(spark, path)
    return ids.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op6_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_neighbours(table(spark, sf_dir, "embeddings"))


def op7_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), file)


def op9_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_heap_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), file)


def op11_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op12_str_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_parallel_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def _shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """The query, after this package has been sent to the workers where they lack it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship_package(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = {
        "op1_co_training": op1_co_training,
        "op2_url_vocabulary": op2_url_vocabulary,
        "op3_sampled_splitters": op3_sampled_splitters,
        "op4_rare_seeds": op4_rare_seeds,
        "op5_token_files": op5_token_files,
        "op6_max_score": op6_max_score,
        "op7_simhash_blocks": op7_simhash_blocks,
        "op8_pattern_packing": op8_pattern_packing,
        "op9_partial_matching": op9_partial_matching,
        "op10_heap_merges": op10_heap_merges,
        "op11_log_bilinear": op11_log_bilinear,
        "op12_str_tree": op12_str_tree,
        "op13_parallel_viterbi": op13_parallel_viterbi,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in made.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_vocabulary": url_filter.judge_sql(), "op6_max_score": topk.TOP_SQL, "op12_str_tree": hard_negatives.MINE_SQL}
