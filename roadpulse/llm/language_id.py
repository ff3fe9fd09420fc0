"""Operator 9: language identification by prediction by partial matching.

For each language a context tree of up to ``ORDER`` bytes is counted over sampled labelled
documents. A byte that a context has seen costs -log2(n / (total + kinds)) bits, where
kinds is the number of different bytes seen there; any other byte costs the escape
-log2(kinds / (total + kinds)) and what it costs in the context that is one byte shorter,
down to a uniform byte. A context that a language has never met costs no escape. The
statistics are frozen, so costs are tables, and the code length of a whole text is the sum
of one looked-up number for each byte and language. The shortest code wins.

The fit takes an even draw by id hash of about ``SAMPLE_DOCS`` documents of each language
(all, if it has no more), or fewer of each where there are so many languages that this would
be over ``SAMPLE_TOTAL`` in all. Every value of ``lang`` is learned. Scoring covers whole texts
of all documents. Tables of all contexts, symbols and languages that would outgrow
``TABLE_BYTES`` are kept sparse, with the same costs: only what was seen is stored.

Null text and text without a letter are ``und`` with score 0, and so is every text if
nothing could be learned. Equal code lengths go to the name that comes first. A null id
counts as the empty id for the held-out rule. Repeated rows are predicted one by one and
learned once. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices, utf8
from roadpulse.llm.workers import kept

ORDER = 3
SAMPLE_DOCS = 2000
SAMPLE_TOTAL = 500_000
FEW_LANGUAGES = 1 << 16  # so many sizes may be broadcast
CELLS = 1 << 21  # bytes of text times languages that are worked on at a time
TABLE_BYTES = 256 << 20
START = 256
RADIX = 257
SLICE = 1 << 20
BLOCK = 1024
UNKNOWN = "und"
RESULT = "struct<lang_pred:string,score:double>"


def padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts with ``ORDER`` start marks before each, the places of the bytes
    in them, and the bounds of the texts among the bytes."""
    data, bounds = utf8(texts)
    marks = ORDER * np.arange(1, len(texts) + 1)
    places = np.arange(len(data)) + np.repeat(marks, np.diff(bounds))
    symbols = np.full(len(data) + ORDER * len(texts), START, np.int64)
    symbols[places] = data
    return symbols, places, bounds


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    symbols, places, _ = padded(texts)
    codes = np.zeros(len(places), np.int64)
    for back in range(ORDER, -1, -1):
        codes = codes * RADIX + symbols[places - back]
    return np.unique(codes, return_counts=True)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """Counts of byte sequences by language, as a model for ``predict``."""
    labelled = docs.select(
        F.xxhash64(id_col).alias("draw"), F.col(lang_col).cast("string").alias("lang"), text_col
    )
    labelled = labelled.where(F.col("lang").isNotNull() & F.col(text_col).isNotNull())
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = sizes.count()
    sizes = F.broadcast(sizes) if languages <= FEW_LANGUAGES else sizes
    place = (F.col("draw").cast("double") + 2.0**63) / 2.0**64
    wanted = min(SAMPLE_DOCS, max(1, SAMPLE_TOTAL // max(1, languages)))
    sampled = labelled.join(sizes, "lang").where(place * F.col("n") <= wanted)
    sampled = sampled.select("lang", F.col(text_col).alias("text")).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, most=SLICE):
            langs = rows.column("lang").to_numpy(zero_copy_only=False)
            for lang in sorted(set(langs)):
                codes, counts = _grams(texts.filter(pa.array(langs == lang)))
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang] * len(codes), pa.string()),
                        "code": pa.array(codes),
                        "n": pa.array(counts.astype(np.int64)),
                    }
                )

    grams = sampled.mapInArrow(count, "lang string, code bigint, n bigint")
    # Bounded by the sample: as many rows as it has different sequences of ORDER + 1 bytes.
    counts = grams.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique().tolist())
    number = counts["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(np.int64)
    codes, n = counts["code"].to_numpy(np.int64), counts["n"].to_numpy(np.float64)
    model = (uuid.uuid4().hex, tuple(langs), number, codes, n)
    return docs.sparkSession.sparkContext.broadcast(model)


class TooLarge(Exception):
    """Dense tables would not fit."""


class SparseCosts:
    """The costs of ``CostTables``, found in sorted lists of what was seen."""

    def __init__(self, langs, number, codes, counts):
        self.langs = langs
        self.orders = []
        for order in range(ORDER + 1):
            grams, n = self._sums(codes % RADIX ** (order + 1) * len(langs) + number, counts)
            contexts = grams // len(langs) // RADIX * len(langs) + grams % len(langs)
            known, place = np.unique(contexts, return_inverse=True)
            kinds = np.bincount(place, minlength=len(known))
            whole = np.bincount(place, n, len(known)) + kinds
            direct, escape = np.log2(whole[place] / n), np.log2(whole / kinds)
            self.orders.append((grams, direct, known, escape))

    @staticmethod
    def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, place = np.unique(keys, return_inverse=True)
        return found, np.bincount(place, counts, len(found))

    def _costs(self, codes: np.ndarray) -> np.ndarray:
        """Bits of a byte after its context, for each code and language."""
        count = len(self.langs)
        every = np.arange(count)
        costs = np.full((len(codes), count), 8.0)
        for order, (grams, direct, known, escape) in enumerate(self.orders):
            gram = codes % RADIX ** (order + 1)
            met, at = _place(known, (gram // RADIX * count)[:, None] + every)
            costs += np.where(met, escape[at], 0.0)
            seen, at = _place(grams, (gram * count)[:, None] + every)
            costs = np.where(seen, direct[at], costs)
        return costs

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of each text under each language."""
        symbols, places, bounds = padded(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        bits = np.zeros((len(texts), len(self.langs)))
        step = max(1, CELLS // max(1, len(self.langs)))
        for begin in range(0, len(places), step):
            at = places[begin : begin + step]
            codes = np.zeros(len(at), np.int64)
            for back in range(ORDER, -1, -1):
                codes = codes * RADIX + symbols[at - back]
            found, place = np.unique(codes, return_inverse=True)
            mine = owner[begin : begin + step]
            firsts = np.flatnonzero(np.diff(mine, prepend=-1))
            bits[mine[firsts]] += np.add.reduceat(self._costs(found)[place], firsts, axis=0)
        return bits


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether numbers are among sorted ``keys``, and where."""
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return keys[at] == wanted, at


class CostTables:
    """``costs[row of the longest known context, symbol]``: bits for each language."""

    def __init__(self, langs, number, codes, counts):
        self.langs = langs
        count = len(langs)
        last = codes % RADIX
        known = np.unique(last)
        self.symbol = np.zeros(START + 1, np.int64)
        self.symbol[known] = np.arange(1, len(known) + 1)
        self.symbol[START] = len(known) + 1
        self.size = len(known) + 2
        symbols = [self.symbol[codes // RADIX**back % RADIX] for back in range(ORDER + 1)]
        orders, cells = [], 0
        for order in range(ORDER + 1):
            context = np.zeros(len(codes), np.int64)
            for back in range(order, 0, -1):
                context = context * self.size + symbols[back]
            found, place = np.unique(context, return_inverse=True)
            cells += len(found) * self.size * count
            if cells * 4 > TABLE_BYTES:
                raise TooLarge
            orders.append((found, place))
        # Rows of shorter contexts stay, for contexts that were never met.
        lengths = [len(found) for found, _ in orders]
        self.costs = np.empty((sum(lengths), self.size, count), np.float32)
        rows, first = np.zeros(1, np.int64), 0
        for order, (found, place) in enumerate(orders):
            shorter = rows[found % self.size ** max(order - 1, 0)] if order else None
            self._fill(first, len(found), place, symbols[0], number, counts, shorter)
            longer = np.tile(rows, self.size) if order else np.zeros(1, np.int64)
            longer[found] = first + np.arange(len(found))
            rows, first = longer, first + len(found)
        self.rows = rows.astype(np.int32)
        self.costs = self.costs.reshape(-1, count)

    def _fill(self, first, length, place, symbol, number, counts, shorter) -> None:
        """Costs of the contexts of one order, some of them at a time to save memory."""
        by_place = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[by_place], np.arange(0, length + BLOCK, BLOCK))
        for at in range(0, length, BLOCK):
            size = min(BLOCK, length - at)
            some = by_place[bounds[at // BLOCK] : bounds[at // BLOCK + 1]]
            seen = np.zeros((size, *self.costs.shape[1:]))
            np.add.at(seen, (place[some] - at, symbol[some], number[some]), counts[some])
            below = 8.0 if shorter is None else self.costs[shorter[at : at + size]]
            total, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
                direct = np.log2((total + kinds) / seen)
            self.costs[first + at : first + at + size] = np.where(seen > 0, direct, escape + below)

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of each text under each language."""
        symbols, places, bounds = padded(texts)
        symbols = self.symbol[symbols].astype(np.int32)
        context = np.zeros(len(places), np.int32)
        for back in range(ORDER, 0, -1):
            context *= self.size
            context += symbols[places - back]
        cells = self.rows[context].astype(np.int64) * self.size + symbols[places]
        bits = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(np.diff(bounds) > 0)
        if len(full):
            bits[full] = np.add.reduceat(self.costs[cells], bounds[full], axis=0, dtype=np.float64)
        return bits


def tables(model) -> CostTables | SparseCosts:
    """Built once in each worker process."""
    key, *counts = model.value

    def build():
        try:
            return CostTables(*counts)
        except TooLarge:
            return SparseCosts(*counts)

    return kept(("language", key), build)


def predict(text: Column, model) -> Column:
    """Struct of ``lang_pred`` and ``score``, the share of the best language in the
    probability that all languages give the text."""

    @F.arrow_udf(RESULT)
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            names, scores = [], []
            for _, part in text_slices([pa.record_batch({"text": column})], most=SLICE):
                bits = tables(model).code_lengths(part)
                best = bits.min(axis=1, keepdims=True)
                names.append(np.argmin(bits, axis=1))
                scores.append(1 / np.exp2(np.maximum(best - bits, -1000.0)).sum(axis=1))
            langs = np.array(model.value[1], object)
            chosen = np.concatenate([np.zeros(0, np.int64), *names])
            yield pa.StructArray.from_arrays(
                [pa.array(langs[chosen], pa.string()), pa.array(np.concatenate([[], *scores]), pa.float64())],
                ["lang_pred", "score"],
            )

    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not model.value[1]:
        return nothing
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return F.when(letters, score(text)).otherwise(nothing)


def held_out(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % 3 == 1


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` of each row, learned from the
    rows that are not held out."""
    model = learn(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    found = docs.select(
        F.col(id_col).alias("id"),
        held_out(F.col(id_col)).alias("held_out"),
        predict(F.col(text_col), model).alias("found"),
    )
    return found.select(
        F.col("id").alias(id_col),
        "held_out",
        F.col("found.lang_pred").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows whose text has a language, with the columns of ``docs``: no shuffle of texts.

    Null, empty and letterless texts have none and go; if nothing could be learned, every
    text goes. A score equal to ``least`` stays. Equal rows are judged alike; rows without an
    id are judged like others. Other columns are carried along, whatever their names.
    """
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    found = predict(F.col("text"), model)
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least))
