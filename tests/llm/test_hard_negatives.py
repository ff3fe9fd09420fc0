"""Operator 12: trees and searches against plain loops, results against all pairs."""

import math

import numpy as np
import pytest

from roadpulse.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows):
    """Results by all pairs, of distinct whole rows."""
    points = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        points.add((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    cut = lambda x: max(-hn.LONGEST, min(hn.LONGEST, x))
    out = []
    for anchor, label, weights in points:
        if anchor % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(weights, other)), vec_id, kind == label)
            for vec_id, kind, other in points
            if vec_id != anchor
        ]
        positives = sorted(x for x in scored if x[2])[:5]
        for minus, positive, _ in positives:
            fits = [x for x in scored if not x[2] and 50 * -minus <= 100 * -x[0] <= 95 * -minus]
            for rank, (score, negative, _) in enumerate(sorted(fits)[:3], 1):
                out.append((anchor, positive, rank, negative, cut(-minus), cut(-score)))
    return sorted(out)


def mined(spark, rows, **settings):
    found = hn.mine(spark.createDataFrame(rows, SCHEMA), **settings)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(map(tuple, found.collect()))


def cloud(count, width=6, labels=3, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (labels, width))
    return [
        (i, (scale * (middle[i % labels] + rng.normal(0, 0.7, width))).tolist(), int(i % labels))
        for i in range(count)
    ]


@pytest.mark.parametrize("size", [8192, 40])
def test_results_are_those_of_all_pairs(spark, size):
    rows = cloud(600)
    want = plain(rows)
    assert len(want) > 60 and mined(spark, rows, size=size) == want


def test_ties_repeated_rows_and_hot_label(spark):
    """Few different vectors, one label with most rows, and rows that occur several times."""
    rows = [(i, [float(i % 3), 1.0, float(i % 2)], 0 if i % 5 else i % 4) for i in range(400)]
    want = plain(rows)
    assert want and mined(spark, rows + rows[:150] * 3, size=50) == want


def test_odd_rows(spark):
    rows = cloud(160) + [
        (None, [1.0] * 6, 1),
        (200, None, 1),
        (250, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
        (300, [float("nan")] * 6, 1),
        (350, [float("inf")] * 6, 1),
        (400, [1.0] * 6, None),
        (450, [], 1),
        (500, [3.0], 1),
        (550, [1.0] * 9, 2),
        (-50, [2.0] * 6, 0),
        (50, [0.5] * 6, 2),
    ]
    want = plain(rows)
    assert want and mined(spark, rows, size=30) == want


def test_extra_columns_and_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hn.mine(empty).collect() == []
    rows = cloud(200)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS row", "'x' AS tree", "2 AS lot", "3 AS score", "4 AS weights"
    )
    assert sorted(map(tuple, hn.mine(table).collect())) == plain(rows)


@pytest.mark.parametrize("scale", [1e6, 1e8, 1e12])
def test_large_components_are_exact(spark, scale):
    rows = cloud(150, scale=scale)
    assert mined(spark, rows) == plain(rows)


def test_boxes_hold_their_rows_and_bound_their_scores():
    rng = np.random.default_rng(5)
    rows = rng.integers(-300, 300, (1000, 10))
    tree = hn.Tree(np.arange(1000), np.zeros(1000, int), rows)
    assert sorted(map(tuple, tree.rows)) == sorted(map(tuple, rows))
    assert len(tree.levels[0][0]) == -(-1000 // hn.LEAF) and len(tree.levels[-1][0]) == 1
    anchors = rng.integers(-300, 300, (7, 10))
    least, most = tree.intervals(anchors)
    scores = anchors @ tree.rows.T
    for level, (low, high) in enumerate(zip(least, most)):
        size = hn.LEAF * hn.FAN**level
        for node in range(low.shape[1]):
            part = scores[:, node * size : (node + 1) * size]
            assert (low[:, node] <= part.min(axis=1)).all() and (part.max(axis=1) <= high[:, node]).all()


def test_search_prunes_and_keeps_equal_bounds():
    rng = np.random.default_rng(6)
    rows = rng.normal(0, 100, (4000, 4)).astype(int)
    tree = hn.Tree(np.arange(4000), np.zeros(4000, int), rows)
    seen = []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    tree.rows = tree.rows.view(Watched)
    anchor = rng.normal(0, 100, 4).astype(int)
    least, most = ([level[0] for level in x] for x in tree.intervals(anchor[None]))
    every = np.ones(4000, bool)
    scores = np.asarray(tree.rows) @ anchor
    want = sorted(zip(-scores, tree.ids))[:5]
    (best,) = tree.search(anchor, least, most, every, least[-1], most[-1], 5)
    assert [(-s, i) for s, i in best] == want and sum(seen) < 2000
    # A low end that equals the k-th best prunes strictly below it only.
    (best,) = tree.search(anchor, least, most, every, np.array([-want[-1][0]]), most[-1], 5)
    assert [(-s, i) for s, i in best] == want
    lows, highs = np.array([100, -900, 100, 7000]), np.array([2000, -800, 101, 6000])
    lists = tree.search(anchor, least, most, every, lows, highs, 3)
    for best, low, high in zip(lists, lows, highs):
        want = sorted((-s, i) for s, i in zip(scores, tree.ids) if low <= s <= high)[:3]
        assert [(-s, i) for s, i in best] == want
