"""Operator 6: exact top-k by MaxScore.

A vector is read as a document of signed terms: component d with sign s is a posting of
the term (d, s). For a query the terms of its own signs add to the score, the others take
from it. The bound of a term is the most that a posting of it adds in a block of documents.

In each block the terms of a query are ordered by bound, and the k-th best score so far
splits them: as many of the smallest as do not reach it together are non-essential, since a
document that has none of the other, essential terms cannot enter the result. Only the
postings of the essential terms are traversed. For the documents met there the terms that
take away are put in, and then the non-essential ones are probed from the greatest bound on, as
long as a document's score and what it can still gain reach the k-th best.

Queries and documents are blocks of bounded rows. Each block of documents first meets the
queries that lie in it; their k-th best scores there go with the queries to all other blocks,
where they split the terms from the start. The results of all blocks are merged by rank.

Vectors that are null or hold a null or non-finite component take no part. Vectors may
differ in length: a missing component is 0. Weights beyond the range of a long are cut to
it; scores are exact, and one beyond that range is returned cut to it. Ties go to the smaller
id. Rows equal in id and weights count once; a query meets no row of its own id. Rows of one
id that differ are queries of one name, whose best are ranked together. Null ids take no part.
Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.hard_negatives import LONGEST, exact_type
from roadpulse.session import materialize

BLOCK = 4096
QUERIES = 512
PROBED = 4  # terms between two tests of what is still competitive


class Postings:
    """Inverted index of a block: for each component the places and weights of either sign,
    and the rows for random access."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.whole = ids[order], rows[order]
        self.cast(np.dtype(np.int64))

    def cast(self, kind) -> None:
        """Numbers in a type in which the scores of a query block are exact."""
        self.rows = self.whole.astype(kind)
        self.lists = []
        for column in self.rows.T:
            more, less = np.flatnonzero(column > 0), np.flatnonzero(column < 0)
            self.lists.append(((more, column[more]), (less, column[less])))
        self.most = np.maximum(self.rows.max(axis=0, initial=0), 0)
        self.least = np.minimum(self.rows.min(axis=0, initial=0), 0)

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The best ``k`` as (score, id), best first, of the documents that reach ``floor``, a
        score that ``k`` documents elsewhere have."""
        bounds = np.where(query > 0, query * self.most, query * self.least)
        order = np.argsort(bounds, kind="stable")
        order = order[query[order] != 0]
        reach = np.cumsum(bounds[order])
        limit = floor
        split = 0 if limit is None else int(np.searchsorted(reach, limit, side="left"))
        if limit is not None and limit > (reach[-1] if len(reach) else 0):
            return []
        essential, others = order[split:], order[:split]
        gains, met = np.zeros(len(self.ids), self.rows.dtype), np.zeros(len(self.ids), bool)
        for term in essential.tolist():
            places, weights = self.lists[term][0 if query[term] > 0 else 1]
            gains[places] += query[term] * weights
            met[places] = True
        # A document without any gain has a score of 0 at most.
        if limit is None or limit <= 0:
            met[:] = True
        met &= self.ids != own
        rest = reach[split - 1] if split else 0
        alive = np.flatnonzero(met)
        if limit is None and len(alive) > k:
            # The scores of some are a limit for all.
            some = alive[np.argsort(-gains[alive], kind="stable")[: 4 * k]]
            limit = np.sort(self.rows[some] @ query)[-k]
        if limit is not None:
            alive = alive[gains[alive] + rest >= limit]
        losses = np.minimum(self.rows[np.ix_(alive, essential)] * query[essential], 0)
        scores = gains[alive] + losses.sum(axis=1)
        for at in range(len(others) - 1, -1, -PROBED):
            if limit is not None:
                keep = scores + reach[at] >= limit
                alive, scores = alive[keep], scores[keep]
            probed = others[max(0, at - PROBED + 1) : at + 1]
            scores = scores + self.rows[np.ix_(alive, probed)] @ query[probed]
        if limit is not None:
            keep = scores >= limit
            alive, scores = alive[keep], scores[keep]
        if len(scores) > k:
            keep = scores >= np.sort(scores)[-k]
            alive, scores = alive[keep], scores[keep]
        pairs = sorted(zip((-scores).tolist(), self.ids[alive].tolist()))[:k]
        return [(int(-score), id_) for score, id_ in pairs]


def integer_weights(vector: Column) -> Column:
    """floor(256 * x) of each component, or null for a vector that takes no part."""
    numbers, end = vector.cast("array<double>"), F.lit(2.0**63)
    scaled = F.transform(numbers, lambda x: F.floor(F.greatest(F.least(x * 256.0, end), -end)))
    whole = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole, scaled)


def search(queries: DataFrame, documents: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """The ``k`` best documents of each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both have ``vec_id`` and ``weights`` (array of bigint).
    """
    count = max(1, -(-documents.count() // block))
    place = F.pmod(F.xxhash64("vec_id", "weights"), F.lit(count)).cast("int")
    row = F.struct("vec_id", "weights")
    blocks = documents.groupBy(place.alias("d")).agg(F.collect_list(row).alias("documents"))
    blocks = materialize(blocks, "document-blocks")
    asked = queries.select(
        F.monotonically_increasing_id().alias("q"), "vec_id", "weights", place.alias("home")
    )
    asked = materialize(asked, "queries")

    def meet(rows: DataFrame, keys: list[str], targets: Column) -> DataFrame:
        """Blocks of queries with equal ``keys``, at the documents of all ``targets``."""
        query = F.struct("q", "vec_id", "weights", "home", "floor")
        sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("_n"))
        dealt = rows.join(F.broadcast(sizes), keys).withColumn("_b", F.pmod(F.xxhash64("q"), F.col("_n")))
        grouped = dealt.groupBy(*keys, "_b").agg(F.collect_list(query).alias("queries"))
        sent = grouped.select("queries", targets.alias("d"))
        # The queries travel; a block of documents moves once. Spark estimates what is sent from the
        # queries before they are copied and would broadcast the copies through the driver.
        return blocks.repartition(min(4 * count, 4096), "d").join(sent.hint("merge"), "d")

    def run_of(first: bool):
        def run(batches):
            last, postings = None, None
            for batch in batches:
                for row in range(batch.num_rows):
                    number = batch.column("d")[row].as_py()
                    if number != last:
                        last, postings = number, Postings(*_matrix(batch.column("documents")[row].values))
                    yield _found(postings, batch.column("queries")[row].values, k, None if first else number)

        return run

    layout = "q bigint, query_id bigint, vec_id bigint, score decimal(38,0)"
    columns = ["d", "documents", "queries"]
    nothing = F.lit(None).cast("decimal(38,0)").alias("floor")
    home = meet(asked.select("*", nothing), ["home"], F.col("home")).select(*columns)
    started = materialize(home.mapInArrow(run_of(True), layout), "own-block")
    kth = started.groupBy("q").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    seeded = asked.join(kth.where(F.col("n") == k).drop("n"), "q", "left").withColumn("all", F.lit(0))
    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    far = meet(seeded, ["all"], every).select(*columns).mapInArrow(run_of(False), layout)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = started.union(far).select("query_id", "vec_id", "score").distinct()
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    limit = F.lit(LONGEST).cast("decimal(38,0)")
    score = F.least(F.greatest("score", -limit), limit).cast("bigint")
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))


def _matrix(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.field("vec_id").to_numpy(zero_copy_only=False)
    weights = rows.field("weights")
    lengths = weights.value_lengths().to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(ids), int(lengths.max(initial=0))), np.int64)
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = weights.flatten().to_numpy()
    return ids, matrix


def _found(postings: Postings, queries: pa.Array, k: int, number: int | None) -> pa.RecordBatch:
    """Results of a block of queries; with the ``number`` of the documents' block, of those
    queries that do not lie in it."""
    ids, vectors = _matrix(queries)
    width = postings.whole.shape[1]
    asked = np.zeros((len(ids), width), np.int64)
    common = min(width, vectors.shape[1])
    asked[:, :common] = vectors[:, :common]
    kind = exact_type(postings.whole, asked)
    if postings.rows.dtype != kind:
        postings.cast(kind)
    asked = asked.astype(kind)
    names, homes = queries.field("q").to_pylist(), queries.field("home").to_pylist()
    floors = queries.field("floor").to_pylist()
    out = []
    for at, id_ in enumerate(ids.tolist()):
        if homes[at] != number:
            floor = None if floors[at] is None else int(floors[at])
            best = postings.search(asked[at], id_, k, floor)
            out += [(names[at], id_, found, score) for score, found in best]
    columns = list(zip(*out)) or [()] * 4
    limit = 10**38 - 1
    kinds = [pa.int64()] * 3 + [pa.decimal128(38, 0)]
    columns[3] = [max(-limit, min(limit, score)) for score in columns[3]]
    labels = ("q", "query_id", "vec_id", "score")
    return pa.record_batch({n: pa.array(c, t) for n, c, t in zip(labels, columns, kinds)})


def top_neighbours(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Rows whose id is divisible by ``every`` as queries against all rows."""
    slim = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), integer_weights(F.col(vector_col)).alias("weights")
    )
    slim = slim.where(F.col("weights").isNotNull() & F.col("vec_id").isNotNull()).distinct()
    slim = materialize(slim, "weights")
    return search(slim.where(F.col("vec_id") % every == 0), slim, k, block)


TOP_SQL = """
    WITH whole AS (
        SELECT vec_id, embedding FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding,
            lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
    ), terms AS (
        SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM whole
    ), weights AS (
        SELECT vec_id, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM terms
    ), scores AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.w * b.w) AS BIGINT) AS score
        FROM weights a JOIN weights b ON a.d = b.d AND a.vec_id <> b.vec_id
        WHERE a.vec_id % 50 = 0
        GROUP BY 1, 2
    ), ranked AS (
        SELECT query_id, vec_id, score,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT)
                   AS rank
        FROM scores
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
