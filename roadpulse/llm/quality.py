"""Operator 1: a quality classifier by co-training.

Two logistic regressions see different views of a document: its text (byte pairs and
shape) and its metadata (source, language, length). They start from labelled documents.
In each round both score every unlabelled document; each hands a draw of those it is sure
of to the other as training rows. At last each view is calibrated on labelled rows that
were kept out of training, and a third regression weighs the two calibrated views. Every
document is scored.

Bounds of the fit: about ``LABELLED`` labelled documents, and in each round about
``EXCHANGED`` pseudo-labels of each view and class among all documents that are ``SURE``,
both drawn evenly by hash. Nothing else is sampled: all documents are scored in each round, whole.

Null text has the features of an empty one; null metadata have values of their own. Labels
without id or quality are left out; several labels of one id count by their mean, 0.5 as
good. Without labels of both classes all documents score 1. Repeated rows and null ids are
scored as they are. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices, utf8
from roadpulse.session import materialize

LABELLED = 20_000
EXCHANGED = 1_000
ROUNDS = 3
SURE = 0.95
PAIRS = 116
SOURCES = 32
LANGS = 8
RIDGE = 1.0
SLICE = 1 << 20


def text_view(texts: pa.Array) -> np.ndarray:
    """Text features of each text, from all of its bytes."""
    data, bounds = utf8(texts)
    count, sizes = len(texts), np.diff(bounds)
    owner = np.repeat(np.arange(count), sizes)
    single = np.bincount(owner * 256 + data, minlength=count * 256).reshape(count, 256)
    inside = owner[1:] == owner[:-1]
    code = (data[:-1].astype(np.int64) * 31 + data[1:].astype(np.int64) * 7) % PAIRS
    pairs = np.bincount((owner[:-1] * PAIRS + code)[inside], minlength=count * PAIRS)
    pairs = np.sqrt(pairs.reshape(count, PAIRS) / np.maximum(sizes, 1)[:, None])
    share = single / np.maximum(sizes, 1)[:, None]
    every = np.arange(256)
    letters = (every >= 65) & (every <= 90) | (every >= 97) & (every <= 122)
    kinds = [
        (every >= 65) & (every <= 90),
        (every >= 48) & (every <= 57),
        every == 32,
        every == 10,
        (every > 32) & (every < 127) & ~letters & ~((every >= 48) & (every <= 57)),
        np.isin(every, list(b"!%$&*#|")),
        every >= 128,
    ]
    shape = []
    for text in texts.to_pylist():
        words, lines = text.split(), text.split("\n")
        shape.append(
            (
                len(set(words)) / max(1, len(words)),
                len(set(lines)) / len(lines),
                np.log1p(len(words)),
                len(text) / max(1, len(words)) / 10,
            )
        )
    shape = np.array(shape).reshape(count, 4)
    parts = [pairs, *(share[:, kind].sum(axis=1, keepdims=True) for kind in kinds), shape]
    return np.hstack([*parts, np.log1p(sizes)[:, None]]).astype(np.float32)


def meta_view(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Metadata features of each row."""
    count = len(source)
    view = np.zeros((count, SOURCES + LANGS + 4), np.float32)

    def mark(values: pa.Array, first: int, buckets: int) -> None:
        coded = values.dictionary_encode()
        names = [zlib.crc32(str(x).encode()) % buckets for x in coded.dictionary.to_pylist()]
        index = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        known = index >= 0
        view[known, first + np.array([*names, 0])[index[known]]] = 1

    mark(source, 0, SOURCES)
    mark(lang, SOURCES, LANGS)
    size = n_chars.cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
    at = SOURCES + LANGS
    view[:, at] = np.log1p(np.maximum(size, 0))
    view[:, at + 1] = view[:, at] ** 2
    view[:, at + 2] = size < 0
    view[:, at + 3] = size == 0
    return view


COLUMNS = ("text", "source", "lang", "n_chars")


def _views(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for rows, texts in text_slices([batch], most=SLICE):
        meta = meta_view(*(rows.column(name) for name in COLUMNS[1:]))
        yield rows, text_view(texts), meta


def with_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``id``, ``label`` (null: none drawn), ``draw`` and both views of each document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    named = named.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    # An even share of the labels: about LABELLED rows.
    place = (F.xxhash64("doc_id").cast("double") + 2.0**63) / 2.0**64
    drawn = F.broadcast(named.where(place * max(1, named.count()) <= LABELLED))
    slim = docs.select(
        F.col("doc_id").alias("id"),
        F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )
    slim = slim.join(drawn.withColumnRenamed("doc_id", "id"), "id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text, meta in _views(batch):
                yield pa.record_batch(
                    {
                        "id": rows.column("id"),
                        "label": rows.column("label"),
                        "text_view": _lists(text),
                        "meta_view": _lists(meta),
                    }
                )

    made = slim.mapInArrow(
        run, f"id {kind}, label int, text_view array<float>, meta_view array<float>"
    )
    return made.withColumn("draw", F.xxhash64("id", "text_view"))


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), pa.float32()))


def _rows(lists: pa.Array) -> np.ndarray:
    if len(lists) == 0:
        return np.zeros((0, 1))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


@dataclass(frozen=True)
class Logistic:
    """Regression on standardized features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = RIDGE) -> Logistic:
        mean, scale = rows.mean(axis=0), rows.std(axis=0)
        scale = np.where(scale > 1e-6, scale, 1.0)
        design = np.hstack([(rows - mean) / scale, np.ones((len(rows), 1))])
        penalty = np.full(design.shape[1], ridge)
        penalty[-1] = 1e-6
        weights = np.zeros(design.shape[1])
        for _ in range(25):
            chance = _sigmoid(design @ weights)
            slope = design.T @ (labels - chance) - penalty * weights
            bend = (design * (chance * (1 - chance))[:, None]).T @ design + np.diag(penalty)
            step = np.linalg.solve(bend, slope)
            weights = weights + step
            if np.abs(step).max() < 1e-6:
                break
        return Logistic(mean, scale, weights)

    def margin(self, rows: np.ndarray) -> np.ndarray:
        if len(rows) == 0:
            return np.zeros(0)
        inner = np.clip((rows - self.mean) / self.scale, -20, 20) @ self.weights[:-1]
        return np.clip(inner + self.weights[-1], -30, 30)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


@dataclass(frozen=True)
class CoTrained:
    views: tuple[Logistic, Logistic]
    calibrations: tuple[Logistic, Logistic]
    combination: Logistic

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated chances of each view, and of both."""
        margins = [
            calibration.margin(view.margin(rows)[:, None])
            for view, calibration, rows in zip(self.views, self.calibrations, (text, meta))
        ]
        both = self.combination.margin(np.column_stack(margins))
        return _sigmoid(margins[0]), _sigmoid(margins[1]), _sigmoid(both)


def _fetch(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table = rows.select("label", "draw", "text_view", "meta_view").toArrow().sort_by("draw")
    table = table.combine_chunks()
    views = []
    for name in ("text_view", "meta_view"):
        column = table.column(name)
        views.append(_rows(column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)))
    label = table.column("label").to_numpy().astype(np.float64)
    return views[0], views[1], label, table.column("draw").to_numpy().astype(np.int64)


def _least(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows of different ``keys``, hashes of the row: equal rows are one, and should the draw
    give more than ``most``, which is twice what is expected, the least hashes stay."""
    return rows.dropDuplicates(keys).orderBy(*keys).limit(most)


def co_train(features: DataFrame, rounds: int = ROUNDS) -> CoTrained | None:
    """Fit on a stored feature table; None without labels of both classes."""
    labelled = features.where(F.col("label").isNotNull())
    text, meta, label, draw = _fetch(_least(labelled, ["draw", "label"], 2 * LABELLED))
    checks = draw % 4 == 0
    for part in (checks, ~checks):
        if len(np.unique(label[part])) < 2:
            return None
    views = [text, meta]
    train = [view[~checks] for view in views]
    given = [[(rows, label[~checks])] for rows in train]
    unlabelled = features.where(F.col("label").isNull())
    models = _fit_views(given)
    for round_ in range(rounds):
        chances = _chances(models)(F.col("text_view"), F.col("meta_view"))
        scored = unlabelled.withColumn("chance", chances)
        sides = {
            (view, good): (F.col("chance")[view] >= SURE) if good else (F.col("chance")[view] <= 1 - SURE)
            for view in (0, 1)
            for good in (0, 1)
        }
        sums = [F.sum(side.cast("bigint")).alias(f"n{v}{g}") for (v, g), side in sides.items()]
        sure = scored.agg(*sums).first()
        # An even share of the sure rows: EXCHANGED of them are expected in each draw.
        spread = F.pmod(F.xxhash64("draw", F.lit(round_)), F.lit(1 << 40)).cast("double") / (1 << 40)
        drawn = []
        for (view, good), side in sides.items():
            share = EXCHANGED / max(sure[f"n{view}{good}"] or 0, EXCHANGED)
            drawn.append(F.when(side & (spread < share), F.lit(f"{view}{good}")))
        picks = scored.withColumn("picks", F.array_compact(F.array(*drawn))).where(F.size("picks") > 0)
        picks = picks.withColumn("pick", F.explode("picks")).withColumn("label", F.col("pick").cast("int"))
        picks = picks.withColumn("place", F.xxhash64("draw", F.lit(round_)))
        new_text, new_meta, pick, _ = _fetch(_least(picks, ["place", "pick"], 8 * EXCHANGED))
        teacher, good = pick // 10, pick % 10
        # What one view is sure of trains the other.
        given[1].append((new_meta[teacher == 0], good[teacher == 0]))
        given[0].append((new_text[teacher == 1], good[teacher == 1]))
        models = _fit_views(given)
    held = [view[checks] for view in views]
    calibrations = tuple(
        Logistic.fit(model.margin(rows)[:, None], label[checks]) for model, rows in zip(models, held)
    )
    margins = [c.margin(m.margin(rows)[:, None]) for c, m, rows in zip(calibrations, models, held)]
    combination = Logistic.fit(np.column_stack(margins), label[checks])
    return CoTrained(models, calibrations, combination)


def _fit_views(given) -> tuple[Logistic, Logistic]:
    made = []
    for parts in given:
        parts = [part for part in parts if len(part[0])]
        rows = np.concatenate([rows for rows, _ in parts])
        made.append(Logistic.fit(rows, np.concatenate([labels for _, labels in parts])))
    return made[0], made[1]


def _chances(models: tuple[Logistic, Logistic]):
    @F.arrow_udf("array<double>")
    def chance(text: pa.Array, meta: pa.Array) -> pa.Array:
        both = [_sigmoid(m.margin(_rows(v))) for m, v in zip(models, (text, meta))]
        flat = pa.array(np.column_stack(both).ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * 2), flat)

    return chance


RESULT = "struct<text_score:double,meta_score:double,score:double>"


def _struct(scores: tuple[np.ndarray, ...]) -> pa.Array:
    return pa.StructArray.from_arrays(
        [pa.array(x, pa.float64()) for x in scores], ["text_score", "meta_score", "score"]
    )


def _all_good() -> Column:
    return F.struct(*[F.lit(1.0).alias(name) for name in ("text_score", "meta_score", "score")])


def score_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """``doc_id``, ``text_score``, ``meta_score``, ``score`` and ``keep`` of each row."""
    features = materialize(with_features(docs, labels), "quality-features")
    model = co_train(features)
    if model is None:
        found = _all_good()
    else:

        @F.arrow_udf(RESULT)
        def judge(text: pa.Array, meta: pa.Array) -> pa.Array:
            return _struct(model.scores(_rows(text), _rows(meta)))

        found = judge("text_view", "meta_view")
    scored = features.select(F.col("id").alias("doc_id"), found.alias("found"))
    scored = scored.select("doc_id", "found.*")
    return scored.withColumn("keep", F.col("score") >= least)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows that score ``least`` or more, with the columns of ``docs``: no shuffle of texts.

    Null texts and metadata are judged by the features they have; a score equal to ``least``
    stays. Equal rows are judged alike and all stay or go; rows without an id are judged too.
    Without labels of both classes, and from an empty table, everything stays. Columns
    beside the five of a document are carried along, whatever their names.
    """
    model = co_train(materialize(with_features(docs, labels), "quality-features"))
    if model is None:
        return docs

    @F.arrow_udf("double")
    def judge(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        batch = pa.record_batch([text, source, lang, n_chars], names=list(COLUMNS))
        parts = [model.scores(a, b)[2] for _, a, b in _views(batch)]
        return pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    score = judge(
        F.col("text").cast("string"),
        F.col("source").cast("string"),
        F.col("lang").cast("string"),
        F.col("n_chars").cast("bigint"),
    )
    return docs.where(score >= least)
