"""Operator 12: hard negatives by best-first search of STR-packed R-trees.

Rows become points of whole numbers. They are packed by sort-tile-recursive: rows of a lot
(some labels) are cut into slabs along one coordinate and these along the next by
quantiles; each tile, of bounded size, is a tree. In a task the tile is sorted and cut
again, along the coordinates of largest spread, into leaves; runs of ``FAN`` nodes have a
common parent. Each node holds the minimum bounding box of its rows.

For an anchor a box gives, in each coordinate, an interval of the product, and their sums
bound the inner products of all its rows. A queue visits nodes by their upper bound, best
first. Boxes that lie wholly outside the window of scores are pruned, and the search ends
when the best bound left is strictly below the k-th best score: equal ones may still hold a
smaller id.

First each tree is searched for the positives of its own anchors; their k-th best scores
go with the anchors to the other trees of the lot, where they prune from the start. Hard
negatives are found in the same way: the anchors meet one tree first and take its k-th best
scores along to all others. Anchors and trees are blocks of bounded size; a tree meets each
block of anchors once, and the results of all trees are merged by rank.

Rows with a null id, label or vector, or with a null or non-finite component take no part.
Vectors may differ in length: a missing component is 0. Rows that are equal in id, label
and weights count once; rows of one id that differ are anchors of their own, and no row of
its own id is a positive or negative of an anchor. Ties go to the smaller id. Weights
beyond the range of a long are cut to it; scores are exact, and one beyond that range is
returned cut to it. Other columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import materialize

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LEAST, MOST = 50, 95  # the window: percent of the positive's score
TREE = 8192  # rows of a tree
ANCHORS = 512  # anchors that meet a tree at a time
TASKS = 4096  # over which trees are spread
LEAF, FAN = 32, 8
VISITED = 16  # boxes that the queue gives at a time
TILED = 4  # coordinates that a tree is tiled along
LONGEST = (1 << 63) - 1


class Tree:
    """An STR-packed R-tree over rows of whole numbers."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = self._tiled(rows, leaf)
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        starts = np.arange(0, len(rows), leaf)
        low, high = (f.reduceat(self.rows, starts, axis=0) for f in (np.minimum, np.maximum))
        # Levels from the leaves up; a node's children are a run of the level below.
        self.levels = [(low, high)]
        while len(self.levels[-1][0]) > 1:
            below = self.levels[-1]
            starts = np.arange(0, len(below[0]), FAN)
            self.levels.append(
                (np.minimum.reduceat(below[0], starts, axis=0), np.maximum.reduceat(below[1], starts, axis=0))
            )
        self.leaf = leaf
        self.whole = self.rows, self.levels

    @staticmethod
    def _tiled(rows: np.ndarray, leaf: int) -> np.ndarray:
        """Order of the rows: slabs along one coordinate, each cut along the next, and so on."""
        spread = rows.max(axis=0, initial=0).astype(float) - rows.min(axis=0, initial=0)
        axes = np.argsort(-spread, kind="stable")[:TILED]

        def cut(places: np.ndarray, axes: np.ndarray) -> list[np.ndarray]:
            if len(axes) == 0 or len(places) <= leaf:
                return [places]
            places = places[np.argsort(rows[places, axes[0]], kind="stable")]
            leaves = -(-len(places) // leaf)
            slabs = int(np.ceil(leaves ** (1 / len(axes))))
            size = leaf * -(-leaves // slabs)
            parts = (places[at : at + size] for at in range(0, len(places), size))
            return [tile for part in parts for tile in cut(part, axes[1:])]

        return np.concatenate(cut(np.arange(len(rows)), axes))

    def cast(self, kind: type) -> None:
        """Change the numbers to a type that holds them."""
        if self.rows.dtype != kind:
            self.rows = self.whole[0].astype(kind)
            self.levels = [(low.astype(kind), high.astype(kind)) for low, high in self.whole[1]]

    def intervals(self, anchors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of each level: least and greatest possible score of each anchor in each node."""
        plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
        least = [plus @ low.T + minus @ high.T for low, high in self.levels]
        most = [plus @ high.T + minus @ low.T for low, high in self.levels]
        return least, most

    def search(self, anchor, least, most, allowed, lows, highs, k: int = POSITIVES) -> list[list[tuple]]:
        """For each window, from ``lows`` to ``highs``: the best ``k`` rows with ``allowed``
        and a score in it, as (score, id), best first, ties by smaller id. ``least`` and
        ``most``: the anchor's intervals. A low end may be raised to a score that ``k`` rows
        elsewhere reach.

        The queue gives the ``VISITED`` boxes of greatest bounds at a time; of those the
        inner ones are replaced by their children and the leaves' rows are scored."""
        limits, found = lows.copy(), [[] for _ in lows]
        levels, nodes = np.array([len(self.levels) - 1]), np.array([0])
        while True:
            bounds = np.array([most[at][node] for at, node in zip(levels.tolist(), nodes.tolist())])
            lowest = np.array([least[at][node] for at, node in zip(levels.tolist(), nodes.tolist())])
            alive = ((bounds >= limits[:, None]) & (lowest <= highs[:, None])).any(axis=0)
            levels, nodes, bounds = levels[alive], nodes[alive], bounds[alive]
            if len(nodes) == 0:
                return [[(-score, id_) for score, id_ in best] for best in found]
            order = np.argsort(-bounds, kind="stable")
            first, later = order[:VISITED], order[VISITED:]
            inner = first[levels[first] > 0]
            leaves = nodes[first[levels[first] == 0]]
            if len(leaves):
                places = (leaves[:, None] * self.leaf + np.arange(self.leaf)).ravel()
                places = places[places < len(self.ids)]
                places = places[allowed[places]]
                scores = self.rows[places] @ anchor
                fits = (scores >= limits[:, None]) & (scores <= highs[:, None])
                for window in np.flatnonzero(fits.any(axis=1)).tolist():
                    at = fits[window]
                    more = zip((-scores[at]).tolist(), self.ids[places[at]].tolist())
                    best = found[window] = sorted([*found[window], *more])[:k]
                    if len(best) == k:
                        limits[window] = max(limits[window], -best[-1][0])
            children = (nodes[inner][:, None] * FAN + np.arange(FAN)).ravel()
            below = np.repeat(levels[inner] - 1, FAN)
            exist = children < np.array([len(x[0]) for x in self.levels])[below]
            levels = np.concatenate([levels[later], below[exist]])
            nodes = np.concatenate([nodes[later], children[exist]])


def exact_type(rows: np.ndarray, anchors: np.ndarray) -> type:
    """A type in which inner products are exact: doubles up to 2^53, longs, or Python's
    numbers."""
    largest = max(1, rows.shape[1]) * _largest(rows) * _largest(anchors)
    return np.float64 if largest < 1 << 53 else np.int64 if largest < LONGEST else object


def _largest(numbers: np.ndarray) -> int:
    return max(abs(int(numbers.min(initial=0))), abs(int(numbers.max(initial=0))))


def _matrix(rows: pa.Array, width: int | None = None) -> np.ndarray:
    """Weights of an array of structs, with zeros for missing components."""
    weights = rows.field("weights")
    lengths = weights.value_lengths().to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(rows), int(lengths.max(initial=0)) if width is None else width), np.int64)
    places = np.arange(int(lengths.max(initial=0))) < lengths[:, None]
    full = np.zeros(places.shape, np.int64)
    full[places] = weights.flatten().to_numpy()
    common = min(full.shape[1], matrix.shape[1])
    matrix[:, :common] = full[:, :common]
    return matrix


def _column(rows: pa.Array, name: str) -> np.ndarray:
    return rows.field(name).to_numpy(zero_copy_only=False)


def _tree(rows: pa.Array) -> Tree:
    return Tree(_column(rows, "vec_id"), _column(rows, "label"), _matrix(rows))


def _met(tree: Tree, anchors: pa.Array) -> Iterator[tuple]:
    """Each anchor's row, weights and intervals in the tree, in exact numbers."""
    weights = _matrix(anchors, tree.rows.shape[1])
    kind = exact_type(tree.rows, weights)
    weights = weights.astype(kind)
    tree.cast(kind)
    least, most = tree.intervals(weights)
    for at in range(len(anchors)):
        yield at, weights[at], [x[at] for x in least], [x[at] for x in most]


FOUND = "anchor bigint, anchor_id bigint, positive bigint, id bigint, score decimal(38,0)"


def _batch(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 5
    kinds = [pa.int64()] * 4 + [pa.decimal128(38, 0)]
    names = ("anchor", "anchor_id", "positive", "id", "score")
    limit = 10**38 - 1
    columns[4] = [max(-limit, min(limit, x)) for x in columns[4]]
    return pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})


def find_positives(tree: Tree, anchors: pa.Array, number: int) -> list[tuple]:
    """Of the anchors that do not have this tree as ``done``."""
    found = []
    ids, labels, rows = (_column(anchors, name) for name in ("vec_id", "label", "row"))
    floors, done = anchors.field("floor").to_pylist(), anchors.field("done").to_pylist()
    for at, weights, least, most in _met(tree, anchors):
        allowed = (tree.labels == labels[at]) & (tree.ids != ids[at])
        if done[at] == number or not allowed.any():
            continue
        low, high = least[-1].copy(), most[-1]
        if floors[at] is not None:
            low[0] = max(low[0], int(floors[at]))
        (best,) = tree.search(weights, least, most, allowed, low, high, POSITIVES)
        found += [(rows[at], ids[at], -1, id_, int(score)) for score, id_ in best]
    return found


def find_negatives(tree: Tree, anchors: pa.Array, number: int) -> list[tuple]:
    """``anchors`` have ``wanted``: their positives with the number and the score of each."""
    found = []
    ids, labels, rows = (_column(anchors, name) for name in ("vec_id", "label", "row"))
    wanted = anchors.field("wanted").to_pylist()
    for at, weights, least, most in _met(tree, anchors):
        allowed = (tree.labels != labels[at]) & (tree.ids != ids[at])
        windows = []
        for positive in wanted[at]:
            score = int(positive["score"])
            low, high = -(-LEAST * score // 100), MOST * score // 100
            if low <= high:
                floor = low if positive["floor"] is None else max(low, int(positive["floor"]))
                windows.append((positive["number"], floor, high))
        if not windows or not allowed.any():
            continue
        numbers, lows, highs = zip(*windows)
        kind = weights.dtype
        lists = tree.search(weights, least, most, allowed, _clipped(lows, kind), _clipped(highs, kind), NEGATIVES)
        for number_, best in zip(numbers, lists):
            found += [(rows[at], ids[at], number_, id_, int(score)) for score, id_ in best]
    return found


def _clipped(numbers: tuple[int, ...], kind: np.dtype) -> np.ndarray:
    """Ends of windows in the type of a tree whose scores may all be smaller than they are."""
    if kind == object:
        return np.array(numbers, object)
    limit = (1 << 53) if kind == np.float64 else LONGEST
    return np.array([max(-limit, min(limit, x)) for x in numbers]).astype(kind)


# --- blocks --------------------------------------------------------------------------


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id``, ``label`` (moved on where the id is divisible by 7) and ``weights``."""
    vector = F.col(vector_col).cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    end = F.lit(2.0**63)
    weights = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x * 256.0, end), -end)))
    number = F.col(id_col).cast("bigint")
    label = F.col(label_col).cast("bigint")
    label = F.when(number % 7 == 0, (label + 1) % 10).otherwise(label)
    slim = vectors.select(
        number.alias("vec_id"), label.alias("label"), F.when(whole, weights).alias("weights")
    )
    return slim.where("vec_id IS NOT NULL AND label IS NOT NULL AND weights IS NOT NULL").distinct()


def packed(points: DataFrame, size: int = TREE) -> DataFrame:
    """``points`` with ``lot`` (of their label) and ``tree``: tiles of about ``size`` rows
    along the first two coordinates, cut by quantiles; a tile with too many equal
    coordinates is divided by hash."""
    lots = max(1, -(-points.count() // size))
    x, y = (F.coalesce(F.get("weights", F.lit(i)), F.lit(0).cast("bigint")) for i in (0, 1))
    tiled = points.withColumns(
        {"lot": F.pmod(F.xxhash64("label"), F.lit(lots)).cast("int"), "_x": x, "_y": y}
    )
    trees = F.ceil(F.count(F.lit(1)) / size)
    slabs = tiled.groupBy("lot").agg(F.ceil(F.sqrt(trees)).alias("_parts"))
    tiled = _cut(tiled, slabs, ["lot"], "_x", "_slab")
    tiles = tiled.groupBy("lot", "_slab").agg(trees.alias("_parts"))
    tiled = _cut(tiled, tiles, ["lot", "_slab"], "_y", "_tile")
    keys = ["lot", "_slab", "_tile"]
    tiled = tiled.join(F.broadcast(tiled.groupBy(*keys).agg(F.round(trees / 2).alias("_parts"))), keys)
    salt = F.pmod(F.xxhash64("vec_id", "weights"), F.greatest("_parts", F.lit(1)).cast("int"))
    tree = F.xxhash64(*keys, salt)
    return tiled.select("vec_id", "label", "weights", "lot", tree.alias("tree"))


def _cut(rows: DataFrame, parts: DataFrame, keys: list[str], along: str, name: str) -> DataFrame:
    """Number of the slab of each row, between quantiles of ``along`` within the groups of
    ``keys``. What is broadcast is a number for each tree to come."""
    steps = 1000
    quantiles = F.percentile_approx(along, [i / steps for i in range(1, steps)]).alias("_q")
    cuts = rows.groupBy(*keys).agg(quantiles).join(parts, keys)
    places = F.filter(F.sequence(F.lit(0), F.col("_parts").cast("int")), lambda i: (i > 0) & (i < F.col("_parts")))
    at = lambda i: F.greatest(F.floor(i * steps / F.col("_parts")).cast("int") - 1, F.lit(0))
    cuts = cuts.select(*keys, F.transform(places, lambda i: F.get("_q", at(i))).alias("_cuts"))
    number = F.size(F.filter("_cuts", lambda cut: F.col(along) > cut))
    return rows.join(F.broadcast(cuts), keys).withColumn(name, number).drop("_cuts")


def tree_blocks(points: DataFrame) -> DataFrame:
    """One row for each tree, with its points."""
    point = F.struct("vec_id", "label", "weights")
    return points.groupBy("lot", "tree").agg(F.collect_list(point).alias("points"))


def anchor_blocks(anchors: DataFrame, key: str, size: int = ANCHORS) -> DataFrame:
    """Blocks of about ``size`` anchors with one ``key``."""
    counts = anchors.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).alias("_blocks"))
    block = F.pmod(F.xxhash64("row"), F.col("_blocks")).alias("block")
    point = F.struct(*[name for name in anchors.columns if name not in ("lot", "tree")])
    return anchors.join(F.broadcast(counts), key).groupBy(key, block).agg(F.collect_list(point).alias("anchors"))


def _meet(blocks: DataFrame, trees: DataFrame, key: str, spread: int, find) -> DataFrame:
    """``find`` on each tree and block of anchors of the same ``key``: the anchors travel to
    the trees. The list of trees is broadcast: 8 bytes for the rows of a whole tree."""
    if key == "tree":
        sent = blocks
    else:
        lists = trees.groupBy(key).agg(F.collect_list("tree").alias("_trees"))
        sent = blocks.join(F.broadcast(lists), key).withColumn("tree", F.explode("_trees"))
    pairs = trees.select("tree", "points").repartition(spread, "tree").join(sent.select("tree", "anchors"), "tree")

    def run(batches):
        last, tree = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column("tree")[row].as_py()
                if number != last:
                    last, tree = number, _tree(batch.column("points")[row].values)
                yield _batch(find(tree, batch.column("anchors")[row].values, number))

    return pairs.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _kth(found: DataFrame, k: int) -> DataFrame:
    """The k-th best score of each anchor and window that has so many."""
    return found.where(F.col("rank") == k).select(
        F.col("anchor").alias("row"), F.col("positive").alias("number"), F.col("score").alias("floor")
    )


def _long(score: Column) -> Column:
    limit = F.lit(LONGEST).cast("decimal(38,0)")
    return F.least(F.greatest(score, -limit), limit).cast("bigint")


def mine(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = EVERY,
    size: int = TREE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``."""
    points = materialize(prepared(vectors, id_col, vector_col, label_col), "points")
    points = packed(points, size).withColumn("row", F.monotonically_increasing_id())
    points = materialize(points, "packed-points")
    trees = materialize(tree_blocks(points).withColumn("all", F.lit(0)), "trees")
    spread = min(4 * max(1, trees.count()), TASKS)
    anchors = points.where(F.col("vec_id") % every == 0).withColumn("all", F.lit(0))
    nothing = F.lit(None).cast("decimal(38,0)").alias("floor")

    # Positives: first in each anchor's own tree, then in the others of its lot.
    own = anchors.select("*", nothing, F.lit(None).cast("bigint").alias("done"))
    first = _meet(anchor_blocks(own, "tree"), trees, "tree", spread, find_positives)
    first = materialize(_ranked(first, POSITIVES), "own-tree")
    seeded = anchors.join(_kth(first, POSITIVES).drop("number"), "row", "left")
    seeded = anchor_blocks(seeded.withColumn("done", F.col("tree")), "lot")
    others = _meet(seeded, trees, "lot", spread, find_positives)
    best = materialize(_ranked(first.drop("rank").union(others), POSITIVES), "positives")
    best = best.withColumn("number", F.col("rank").cast("bigint"))

    # Negatives: first in two trees (of different lots, if there are), then in all others.
    wanted = F.collect_list(F.struct("number", "score", "floor")).alias("wanted")
    listed = best.select(F.col("anchor").alias("row"), "number", "score", nothing)
    asking = materialize(anchors.join(listed.groupBy("row").agg(wanted), "row"), "asking")
    one = trees.groupBy("lot").agg(F.max(F.struct(F.size("points"), "tree")).alias("one"))
    head = [r[0] for r in one.orderBy(F.desc("one")).select("one.tree").limit(2).collect()]
    chosen = F.col("tree").isin(head)
    started = _meet(anchor_blocks(asking, "all"), trees.where(chosen), "all", len(head) or 1, find_negatives)
    started = materialize(_ranked(started, NEGATIVES), "first-negatives")
    listed = listed.drop("floor").join(_kth(started, NEGATIVES), ["row", "number"], "left")
    asking = asking.drop("wanted").join(listed.groupBy("row").agg(wanted), "row")
    rest = _meet(anchor_blocks(asking, "all"), trees.where(~chosen), "all", spread, find_negatives)
    found = _ranked(started.drop("rank").union(rest), NEGATIVES)
    named = best.select(
        "anchor",
        F.col("number").alias("positive"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return found.join(named, ["anchor", "positive"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        _long(F.col("positive_score")).alias("positive_score"),
        _long(F.col("score")).alias("negative_score"),
    )


MINE_SQL = """
    WITH whole AS (
        SELECT vec_id, embedding,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding,
            lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
    ), terms AS (
        SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM whole
    ), weights AS (
        SELECT vec_id, label, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM terms
    ), scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
               CAST(sum(a.w * b.w) AS BIGINT) AS score
        FROM weights a JOIN weights b ON a.d = b.d AND a.vec_id <> b.vec_id
        WHERE a.vec_id % 50 = 0
        GROUP BY 1, 2, 3
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score
        FROM scores WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (
               PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT alike AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
    QUALIFY rank <= 3
"""
