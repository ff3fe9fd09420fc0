"""Token ids of whole texts, by the tokenizers library, each distinct chunk encoded once.

A text is divided where the tokenizer divides it anyway, at single spaces above all, so
that its ids are those of its chunks. A worker keeps the ids of the chunks it has met; texts in
which a space follows white space, or which may hold a special string, are given whole to
the library.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadpulse.llm.arrow import gather
from roadpulse.llm.workers import kept

SPACES = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
GROUP = 2000
# Chunks a worker keeps: some 150 bytes each.
CACHE = 1_000_000
# Marks that often end a chunk.
MARKS = ".,;:!?"
# Fixed value: the division of vocabularies that drop white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class ChunkEncoder:
    """``leading_space``: a chunk takes the space before it (byte-level files), or none."""

    def __init__(self, path: str, cache_limit: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.leading_space = bool((layout["pre_tokenizer"] or {}).get("use_regex"))
        self.specials = [token["content"] for token in layout["added_tokens"]]
        self.drops_space = not self.leading_space and _drops_space(layout)
        vocab = self.library.get_vocab()
        opens = np.zeros(max(vocab.values()) + 1, bool)
        opens[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        self.opens, self.closes = opens, np.zeros_like(opens)
        suffix = layout["model"].get("end_of_word_suffix")
        if suffix:
            self.closes[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.cache_limit = cache_limit
        self._clear()

    def _clear(self) -> None:
        # Places of chunks that follow a space, and of those that begin a text.
        self.spaced, self.first = _Slots(), _Slots()
        self.pool = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = self.count = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each."""
        if self.drops_space:
            divided = self._divided(texts)
            odd = pc.match_substring(divided, "\0")
        else:
            divided = texts
            odd = pc.match_substring_regex(texts, SPACES + " ")
        for special in self.specials:
            odd = pc.or_(odd, pc.match_substring(divided, special))
        odd = odd.to_numpy(zero_copy_only=False).astype(bool)
        if self.count > self.cache_limit:
            self._clear()
        counts = np.zeros(len(texts), np.int64)
        plain = divided.filter(pa.array(~odd)) if odd.any() else divided
        ids, counts[~odd] = self._by_chunks(plain)
        if not odd.any():
            return ids, counts
        whole = [self._each([text.as_py()])[0] for text in texts.filter(pa.array(odd))]
        counts[odd] = [len(x) for x in whole]
        pool = np.concatenate([ids, *whole])
        starts = np.zeros(len(texts), np.int64)
        starts[~odd] = np.cumsum(counts[~odd]) - counts[~odd]
        starts[odd] = len(ids) + np.cumsum(counts[odd]) - counts[odd]
        return gather(pool, starts, counts), counts

    def _divided(self, texts: pa.Array) -> pa.Array:
        """Fewer different chunks with the same ids: lower case, and a space before a full
        stop or comma that follows a letter or digit. What the letter is, is decided after
        the file's normal form (NFC): a text that it changes is left as it is, as are texts
        with marks, whose composition may depend on the case, and with U+0130, which becomes
        a letter with a mark."""
        marked = pc.match_substring_regex(texts, r"[\pM\x{130}]")
        # Below U+0300 every letter is its own normal form.
        high = pc.and_not(pc.match_substring_regex(texts, r"[^\x{0}-\x{2ff}]"), marked)
        if pc.any(high).as_py():
            some = texts.filter(high)
            changed = pc.not_equal(pc.utf8_normalize(some, "NFC"), some)
            marked = pc.replace_with_mask(marked, high, changed)
        lower = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        spaced = pc.replace_substring(pc.replace_substring(lower, ". ", " . "), ", ", " , ")
        joined = pc.match_substring_regex(lower, r"[^\pL\pN][.,] |^[.,] ")
        return pc.if_else(marked, texts, pc.if_else(joined, lower, spaced))

    def _by_chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(texts) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        pieces = pc.split_pattern(texts, " ")
        bounds = np.asarray(pieces.offsets, np.int64)
        coded = pieces.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        chunks = coded.dictionary.to_numpy(zero_copy_only=False)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        slots = self._slots(self.spaced, chunks.tolist())[codes]
        if self.leading_space:
            begins, place = np.unique(codes[bounds[:-1]], return_inverse=True)
            slots[bounds[:-1]] = self._slots(self.first, chunks[begins].tolist())[place]
        lengths = self.lengths[slots]
        ends = np.concatenate([[0], np.cumsum(lengths)])[bounds]
        return gather(self.pool, self.starts[slots], lengths), np.diff(ends)

    def _slots(self, table: _Slots, chunks: list[str]) -> np.ndarray:
        found = np.fromiter(map(table.__getitem__, chunks), np.int64, len(chunks))
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh = [chunks[at] for at in new.tolist()]
            self._add(table, fresh)
            found[new] = np.fromiter(map(table.__getitem__, fresh), np.int64, len(fresh))
        return found

    def _add(self, table: _Slots, fresh: list[str]) -> None:
        ended = []
        if self.leading_space:
            # The division cuts a mark off the letter or digit before it.
            ended = [x for x in fresh if x[-1:] in MARKS and len(x) > 1 and x[-2].isalnum()]
        if ended:
            apart = set(ended)
            bodies = dict.fromkeys(x for x in fresh if x not in apart)
            bodies.update(dict.fromkeys(x[:-1] for x in ended))
            fresh = [x for x in bodies if x not in table]
        for at in range(0, len(fresh), GROUP):
            self._encoded(table, fresh[at : at + GROUP])
        if ended:
            marks = self._slots(self.first, list(MARKS))
            pairs = np.empty(2 * len(ended), np.int64)
            pairs[::2] = np.fromiter((table[x[:-1]] for x in ended), np.int64, len(ended))
            pairs[1::2] = marks[[MARKS.index(x[-1]) for x in ended]]
            lengths = self.lengths[pairs]
            ids = gather(self.pool, self.starts[pairs], lengths)
            self._keep(table, ended, ids, lengths[::2] + lengths[1::2])

    def _encoded(self, table: _Slots, chunks: list[str]) -> None:
        if not self.leading_space:
            if self.drops_space:
                letters = [x for x in chunks if x.isalpha() and _plain(x)]
                self._keep(table, letters, *self._letters(letters))
                apart = set(letters)
                chunks = [x for x in chunks if x not in apart]
            ids, lengths = self._divisions(chunks)
        elif table is self.first:
            ids, lengths = self._apart(chunks)
        else:
            alone = [x for x in chunks if not x or x[-1].isspace()]
            if alone:
                apart = set(alone)
                chunks = [x for x in chunks if x not in apart]
                self._keep(table, alone, *self._apart([" " + x for x in alone]))
            ids, lengths = self._joined(chunks)
        self._keep(table, chunks, ids, lengths.astype(np.int64))

    def _divisions(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = self.library.encode_batch([chunks], is_pretokenized=True, add_special_tokens=False)[0]
        lengths = np.bincount(np.array(made.word_ids, np.int64), minlength=len(chunks))
        return np.array(made.ids, np.int32), lengths

    def _letters(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that are one word each: each closes with the only such token."""
        made = self.library.encode_batch_fast([" ".join(chunks)], add_special_tokens=False)[0]
        ids = np.array(made.ids, np.int32)
        closing = np.flatnonzero(self.closes[ids])
        if len(closing) != len(chunks) or len(ids) != (closing[-1] + 1 if len(closing) else 0):
            return self._divisions(chunks)
        return ids, np.diff(np.concatenate([[-1], closing]))

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks after the only space in each: each opens with the only such token."""
        if not chunks:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        whole = " " + " ".join(chunks)
        made = self.library.encode_batch_fast([whole], add_special_tokens=False)[0]
        ids = np.array(made.ids, np.int32)
        opening = np.flatnonzero(self.opens[ids])
        if len(opening) != len(chunks) or opening[0] != 0:
            return self._apart([" " + x for x in chunks])
        return ids, np.diff(np.append(opening, len(ids)))

    def _apart(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self._each(chunks)
        lengths = np.array([len(x) for x in each], np.int64)
        return np.concatenate([np.zeros(0, np.int32), *each]), lengths

    def _each(self, chunks: list[str]) -> list[np.ndarray]:
        made = self.library.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(x.ids, np.int32) for x in made]

    def _keep(self, table: _Slots, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first, self.count = self.count, self.count + len(chunks)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.count > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.starts[first : self.count] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : self.count] = lengths
        self.used += len(ids)
        table.update(zip(chunks, range(first, self.count)))


def _plain(letters: str) -> bool:
    """Whether letters stay letters in the file's normal form and lower case."""
    return letters.isascii() or (unicodedata.is_normalized("NFC", letters) and "\u0130" not in letters)


class _Slots(dict):
    def __missing__(self, chunk: str) -> int:
        return -1


def _drops_space(layout: dict) -> bool:
    """Whether the file lower-cases and divides texts by ``WORDS`` alone."""
    steps = (layout["normalizer"] or {}).get("normalizers", [])
    kinds = [step["type"] for step in steps]
    divisions = (layout["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    pattern = divisions[0].get("pattern", {}).get("Regex")
    return kinds == ["NFC", "Replace", "Lowercase"] and pattern == WORDS


def encoder(path: str, cache_limit: int = CACHE) -> ChunkEncoder:
    """One for each worker process, kept between its tasks."""
    return kept(("encoder", path, cache_limit), lambda: ChunkEncoder(path, cache_limit))
