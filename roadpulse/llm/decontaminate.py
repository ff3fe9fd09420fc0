"""Operator 4: benchmark decontamination by rare n-gram seeds and local alignment.

Texts are lower-cased words (runs of letters and digits). Words of the test items form a
vocabulary; all other words of a document are one unknown word.

1. Passages: where a document has an n-gram of ``SEED_WORDS`` words that some test item
   has, the words around it (as far as an alignment of the longest item can reach) are cut
   out; overlapping cuts are one passage. This is one pass over the texts; nothing else of
   them moves on. An item of fewer words is one seed as a whole.
2. Rare seeds: different passages with each n-gram are counted over the whole corpus. A
   passage is joined to an item at the n-grams they share, the rarest first: Smith-Waterman
   alignment (match 2, other word or gap -1) scores the item against the part of the passage
   that an alignment through that seed can reach. The first seed that scores enough decides; a
   more frequent one is tried only where rarer ones have failed, and only outside of what they
   have reached. So no count keeps a passage from an item, and what is found does not depend on
   the counts; they save alignments.
3. A pair is left out only where the words in common, each as often as both have it, are
   too few for the score, and a seed only where the best run of such words around it is. An
   item of L words is found if its score is that of
   ``needed_words(L)`` matches: 0.4 of the item, at least 7 words and at most 30, and all
   words of an item of up to 7.

Test items are taken in slices of at most ``SLICE_WORDS`` words, so that what each task is
sent is bounded for a benchmark of any size; each slice is one more pass over the corpus.

A copy without ``SEED_WORDS`` intact words in a row is not found. Null texts and items are
empty; an empty item is never found. Repeated rows of a document or item count once in the
result, with their best score; of equal scores the later place in the document counts.
Documents without id and items without id take no part. Other columns are not read. Empty
tables give an empty result.
"""

from __future__ import annotations

import math
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices
from roadpulse.session import materialize

SEED_WORDS = 3
SLICE_WORDS = 4_000_000
KNOWN_BYTES = 32 << 20
MATCH, OTHER = 2, -1
WORD = re.compile(r"[^\W_]+")


def needed_words(length: int) -> int:
    return min(length, 30, max(7, math.ceil(0.4 * length)))


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Vocabulary:
    """Words and n-grams of a slice of the test items."""

    def __init__(self, texts: list[str]):
        split = [words(text) for text in texts]
        self.numbers = {w: i + 1 for i, w in enumerate(sorted({w for x in split for w in x}))}
        self.items = [self.code(x) for x in split]
        sizes = [min(len(item), SEED_WORDS) for item in self.items]
        self.sizes = sorted({size for size in sizes if size})
        grams = [gram_hashes(item, size) for item, size in zip(self.items, sizes)]
        listed = np.concatenate([np.zeros(0, np.int64), *grams])
        order = np.argsort(listed, kind="stable")
        self.grams, begins = np.unique(listed[order], return_index=True)
        self.bounds = np.append(begins, len(listed))
        # Item of each n-gram and its place there.
        lengths = [len(x) for x in grams]
        self.owners = np.repeat(np.arange(len(grams)), lengths)[order]
        self.places = np.concatenate([np.zeros(0, np.int64), *map(np.arange, lengths)])[order]
        self.bags = [np.unique(item, return_counts=True) for item in self.items]
        # An alignment gains 2 for each word of the item and loses 1 for each word it passes.
        self.reach = 3 * max([0, *map(len, self.items)])

    def code(self, found: list[str]) -> np.ndarray:
        get = self.numbers.get
        return np.array([get(word, 0) for word in found], np.int64)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known n-grams in a text, and their numbers."""
        starts, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        known = codes > 0
        for size in self.sizes:
            if len(codes) < size:
                continue
            runs = np.lib.stride_tricks.sliding_window_view(known, size).all(axis=1)
            at = np.flatnonzero(runs)
            hashes = gram_hashes(codes, size, at)
            place = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
            met = self.grams[place] == hashes
            starts.append(at[met])
            numbers.append(place[met])
        return np.concatenate(starts), np.concatenate(numbers)

    def passages(self, codes: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """First word, codes and known n-grams (distinct) of each passage of a document."""
        at, numbers = self.hits(codes)
        if len(at) == 0:
            return []
        order = np.argsort(at, kind="stable")
        at, grams = at[order], self.grams[numbers[order]]
        breaks = np.flatnonzero(np.diff(at) > 2 * self.reach) + 1
        found = []
        for hits, own in zip(np.split(at, breaks), np.split(grams, breaks)):
            first = max(0, int(hits[0]) - self.reach)
            last = min(len(codes), int(hits[-1]) + SEED_WORDS + self.reach)
            found.append((first, codes[first:last], np.unique(own)))
        return found

    @cached_property
    def seen(self) -> np.ndarray:
        """How often a passage has each word; zero between calls."""
        return np.zeros(len(self.numbers) + 1, np.int64)

    @cached_property
    def member(self) -> np.ndarray:
        """Words of an item; false between calls."""
        return np.zeros(len(self.numbers) + 1, bool)

    def shared(self, codes: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Those of the items that have enough words in common with a passage."""
        there, times = np.unique(codes, return_counts=True)
        self.seen[there] = times
        enough = [
            np.minimum(self.seen[numbers], often).sum() >= needed_words(len(self.items[item]))
            for item in items.tolist()
            for numbers, often in (self.bags[item],)
        ]
        self.seen[there] = 0
        return items[np.array(enough, bool)]

    def found(self, codes: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Items in a passage: number, score and the words that are aligned (begin, end).
        ``counts``: in how many passages each n-gram is."""
        at, numbers = self.hits(codes)
        sizes = self.bounds[numbers + 1] - self.bounds[numbers]
        shift = np.repeat(self.bounds[numbers] - (np.cumsum(sizes) - sizes), sizes)
        listed = shift + np.arange(len(shift))
        owners, inner = self.owners[listed], self.places[listed]
        outer, often = np.repeat(at, sizes), np.repeat(counts[numbers], sizes)
        # By item, and there the rarest first.
        order = np.lexsort((outer, often, owners))
        owners, inner, outer = owners[order], inner[order], outer[order]
        results = []
        for item in self.shared(codes, np.unique(owners)).tolist():
            begin, end = np.searchsorted(owners, [item, item + 1])
            best = self._aligned(codes, self.items[item], inner[begin:end], outer[begin:end])
            if best is not None:
                results.append((item, *best))
        return results

    def _aligned(self, codes, item, inner, outer) -> tuple[int, int, int] | None:
        """Score and span of the first seed at which the item scores enough."""
        needed, tried = MATCH * needed_words(len(item)), []
        # A word of the passage adds 2 at most if the item has it, and costs 1 otherwise: the
        # best run of words around a seed bounds every alignment through it.
        self.member[item] = True
        gains = np.where(self.member[codes], MATCH, OTHER)
        self.member[item] = False
        sums = np.concatenate([[0], np.cumsum(gains)])
        most = np.maximum.accumulate(sums[::-1])[::-1]
        bound = most[outer + 1] - np.minimum.accumulate(sums)[outer]
        inner, outer = inner[bound >= needed], outer[bound >= needed]
        first = np.maximum(outer - 3 * inner, 0)
        last = np.minimum(outer + 3 * (len(item) - inner), len(codes))
        for a, b in zip(first.tolist(), last.tolist()):
            if any(x <= a and b <= y for x, y in tried):
                continue
            # Copies of one item close to each other are met in one window.
            a, b = max(0, a - 2 * len(item)), min(len(codes), b + 2 * len(item))
            tried.append((a, b))
            score, begin, end = align(codes[a:b], item)
            if score >= needed:
                return score, a + begin, a + end
        return None


def gram_hashes(codes: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the n-gram of ``size`` words at each place."""
    if at is None:
        at = np.arange(max(0, len(codes) - size + 1) if size else 0)
    hashes = np.full(len(at), 0x9E3779B97F4A7C15 ^ size, np.uint64)
    for step in range(size):
        hashes = (hashes ^ codes[at + step].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(29)
    return hashes.view(np.int64)


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local score, and the words of the passage it spans (begin, end).

    A row of the table is filled at once: gaps along the row are a running maximum.
    """
    width = len(passage)
    steps = np.arange(width + 1)
    above = np.zeros(width + 1, np.int64)
    begins = steps.copy()
    best, span = 0, (0, 0)
    for word in item.tolist():
        same = np.where((passage == word) & (word > 0), MATCH, OTHER)
        row, begin = np.zeros(width + 1, np.int64), steps.copy()
        diagonal = above[:-1] + same
        down = above[1:] + OTHER
        take = diagonal >= down
        value = np.where(take, diagonal, down)
        source = np.where(take, begins[:-1], begins[1:])
        good = value > 0
        row[1:][good], begin[1:][good] = value[good], source[good]
        # A gap along the row costs one for each step.
        lifted = row + steps
        peak = np.maximum.accumulate(lifted)
        owner = np.maximum.accumulate(np.where(lifted == peak, steps, 0))
        along = peak - steps
        better = along > row
        row, begin = np.where(better, along, row), np.where(better, begin[owner], begin)
        at = int(np.argmax(row))
        if row[at] > best:
            best, span = int(row[at]), (int(begin[at]), at)
        above, begins = row, begin
    return best, *span


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS
) -> DataFrame:
    """One row for each pair of a contaminated document and a test item found in it:
    ``doc_id``, ``item_id``, ``score``, ``item_words``, and the words of the document that
    are aligned (``first_word``, ``last_word``)."""
    items = benchmark.select(
        F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).where(F.col("item_id").isNotNull()).distinct()
    size = F.length("text") / 2 + 1
    slices = max(1, math.ceil((items.agg(F.sum(size)).first()[0] or 0) / slice_words))
    slim = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    found = None
    for number in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == number)
        leaks = _leaks_of_slice(slim, part)
        found = leaks if found is None else found.union(leaks)
    best = F.max(F.struct("score", "item_words", "first_word", "last_word")).alias("best")
    pairs = found.groupBy("doc_id", "item_id").agg(best)
    return pairs.select("doc_id", "item_id", "best.*")


def _leaks_of_slice(docs: DataFrame, items: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    rows = items.collect()
    names = [row["item_id"] for row in rows]
    sent = spark.sparkContext.broadcast(Vocabulary([row["text"] for row in rows]))

    def cut(batches):
        vocabulary = sent.value
        for batch, texts in text_slices(batches):
            out = []
            for row, text in enumerate(texts.to_pylist()):
                for first, codes, grams in vocabulary.passages(vocabulary.code(words(text))):
                    out.append((row, first, codes, grams))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(pa.array([x[0] for x in out], pa.int64())),
                    "first": pa.array([x[1] for x in out], pa.int64()),
                    "codes": pa.array([x[2] for x in out], pa.list_(pa.int32())),
                    "grams": pa.array([x[3] for x in out], pa.list_(pa.int64())),
                }
            )

    passages = docs.mapInArrow(
        cut, f"doc_id {id_kind}, first bigint, codes array<int>, grams array<bigint>"
    )
    passages = materialize(passages, "passages")
    each = passages.select(F.xxhash64("codes").alias("passage"), F.explode("grams").alias("gram"))
    counts = each.distinct().groupBy("gram").count()
    # One row for each n-gram of the slice at most.
    frequency = np.zeros(len(sent.value.grams), np.int64)
    for row in counts.collect():
        frequency[np.searchsorted(sent.value.grams, row["gram"])] = row["count"]
    order = spark.sparkContext.broadcast(frequency)

    def score(batches):
        vocabulary, frequency = sent.value, order.value
        items_ = vocabulary.items
        known, size = {}, 0
        for batch in batches:
            out = []
            for row, codes in enumerate(batch.column("codes")):
                passage = codes.values.to_numpy(zero_copy_only=False)
                key = passage.tobytes()
                # Equal passages are scored once, as far as the memory for them reaches.
                if key not in known:
                    if size > KNOWN_BYTES:
                        known, size = {}, 0
                    known[key] = vocabulary.found(passage, frequency)
                    size += len(key) + 200 * (1 + len(known[key]))
                out += [(row, *found) for found in known[key]]
            kept = pa.array([x[0] for x in out], pa.int64())
            first = batch.column("first").take(kept).to_numpy(zero_copy_only=False)
            item_type = pa.int64() if item_kind == "bigint" else None
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(kept),
                    "item_id": pa.array([names[x[1]] for x in out], item_type),
                    "score": pa.array([x[2] for x in out], pa.int32()),
                    "item_words": pa.array([len(items_[x[1]]) for x in out], pa.int32()),
                    "first_word": pa.array(first + [x[3] for x in out], pa.int64()),
                    "last_word": pa.array(first + [x[4] - 1 for x in out], pa.int64()),
                }
            )

    return passages.select("doc_id", "first", "codes").mapInArrow(
        score,
        f"doc_id {id_kind}, item_id {item_kind}, score int, item_words int,"
        " first_word bigint, last_word bigint",
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no test item is found, with their columns; those without id stay.

    Rows that share an id go together. Null and empty texts hold nothing and stay, as does
    everything if there are no items. Equal rows stay as often as they occur. The ids to drop
    are stored, so that Spark knows their size: it sends them to the documents below its
    limit for broadcasts, and shuffles both sides by id beyond it.
    """
    leaks = materialize(find_leaks(docs, benchmark).select("doc_id").distinct(), "leaks")
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
