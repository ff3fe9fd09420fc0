"""Operator 10: token counts by heap-and-linked-list byte-pair merging.

A pre-token is a linked list of byte symbols. The adjacent pair of lowest rank, the
leftmost of equals, is popped from a heap and merged until no ranked pair is left. The
count is the number of first symbols less the number of merges, so no ids are emitted.
Counts of chunks and pre-tokens met before are kept by the worker.

Null text counts as empty (0 bytes, 0 tokens). Rows stand for themselves: repeated rows
and null ids are counted and returned as they are. Other columns are not read.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices
from roadpulse.llm.tokens import SPACES
from roadpulse.llm.workers import kept

WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Fixed pattern of byte-level vocabularies.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{L}\p{N}" + WHITE[1:]
    + f"+|{WHITE}+(?!{WHITE.replace('[', '[^')})|{WHITE}+"
)


class MergeCounter:
    def __init__(self, path: str, cache_limit: int = 1_000_000):
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        vocab, merges = layout["model"]["vocab"], layout["model"]["merges"]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in merges]
        self.merges = {
            (vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.symbols = [vocab[char] for char in byte_chars()]
        self.pattern = regex.compile(WORDS)
        specials = sorted((x["content"] for x in layout["added_tokens"]), key=len, reverse=True)
        self.special_texts = specials
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.cache_limit = cache_limit
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def merged(self, data: bytes) -> int:
        """Number of tokens of one pre-token."""
        size = len(data)
        if size < 2:
            return size
        merges, symbols = self.merges, self.symbols
        ids = [symbols[byte] for byte in data]
        heap = []
        for at in range(size - 1):
            found = merges.get((ids[at], ids[at + 1]))
            if found:
                heap.append((found[0], at, found[1]))
        if not heap:
            return size
        heapq.heapify(heap)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        done = 0
        while heap:
            rank, left, made = heapq.heappop(heap)
            right = after[left]
            if ids[left] < 0 or right >= size:
                continue
            if merges.get((ids[left], ids[right]), (-1,))[0] != rank:
                continue
            ids[left], ids[right] = made, -1
            done += 1
            follow = after[left] = after[right]
            if follow < size:
                before[follow] = left
                found = merges.get((made, ids[follow]))
                if found:
                    heapq.heappush(heap, (found[0], left, found[1]))
            lead = before[left]
            if lead >= 0:
                found = merges.get((ids[lead], made))
                if found:
                    heapq.heappush(heap, (found[0], lead, found[1]))
        return size - done

    def piece(self, text: str) -> int:
        """Number of tokens of a text without special strings."""
        total, words = 0, self.words
        for word in self.pattern.findall(text):
            count = words.get(word)
            if count is None:
                count = self.merged(word.encode())
                if len(word) <= 64:
                    words[word] = count
            total += count
        return total

    def whole(self, text: str) -> int:
        if self.specials is None:
            return self.piece(text)
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(map(self.piece, parts))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Token counts of texts without nulls."""
        if len(self.words) > self.cache_limit or len(self.chunks) > self.cache_limit:
            self.words, self.chunks = {}, {}
        odd = pc.match_substring_regex(texts, SPACES + " ")
        for special in self.special_texts:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        odd = odd.to_numpy(zero_copy_only=False).astype(bool)
        counts = np.zeros(len(texts), np.int64)
        counts[odd] = [self.whole(text.as_py()) for text in texts.filter(pa.array(odd))]
        plain = texts.filter(pa.array(~odd))
        if len(plain):
            pieces = pc.split_pattern(plain, " ")
            bounds = np.asarray(pieces.offsets, np.int64)
            coded = pieces.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
            bounds = bounds - bounds[0]
            chunks = coded.dictionary.to_pylist()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            sizes = np.array([self._chunk(" " + chunk) for chunk in chunks], np.int64)[codes]
            firsts = bounds[:-1]
            sizes[firsts] = [self._chunk(chunks[code]) for code in codes[firsts]]
            counts[~odd] = np.add.reduceat(sizes, firsts)
        return counts

    def _chunk(self, chunk: str) -> int:
        count = self.chunks.get(chunk)
        if count is None:
            count = self.piece(chunk)
            if len(chunk) <= 64:
                self.chunks[chunk] = count
        return count


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies print for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {byte: chr(byte) for byte in shown}
    hidden = (byte for byte in range(256) if byte not in chars)
    chars |= {byte: chr(256 + place) for place, byte in enumerate(list(hidden))}
    return [chars[byte] for byte in range(256)]


def counter(path: str) -> MergeCounter:
    """One for each worker process, kept between its tasks."""
    return kept(("counter", path), lambda: MergeCounter(path))


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row's whole text.

    ``path`` is a byte-level BPE file that each executor can open. One pass, no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        model = counter(path)
        for rows, texts in text_slices(batches):
            yield pa.record_batch(
                {
                    "id": rows.column("id"),
                    "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                    "n_tokens": pa.array(model.counts(texts)),
                }
            )

    counted = slim.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
