import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from roadpulse.llm import packing, token_counts, token_files
from roadpulse.llm.token_counts import MergeCounter
from roadpulse.llm.tokens import ChunkEncoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    " ", "  ", "   ", "\n", "\t", "\r\n", "a", "The", "ing", "é", "é", "ß", "İ", "'s", "'ll",
    ".", "!!", "###", "1", "23", "<|endoftext|>", "<|startoftext|>", "　", "\x85", "\x1c",
    "日本", "Σ", "H\u0331", "\u212a", ". ", ", ", "…. ", "\0", "<|ENDOFTEXT|>", "\ufb01", "I'S. ", "\U0001f600", "​", "\xa0", "_",
]


def encoded(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_chunks_give_the_library_s_ids(path):
    draw = random.Random(7)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 30))) for _ in range(3000)]
    ids, counts = ChunkEncoder(path).encode(pa.array(texts))
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert counts.tolist() == [len(x.ids) for x in whole]
    assert ids.tolist() == [i for x in whole for i in x.ids]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_letter_that_the_normal_form_changes(path):
    """Some decompose into a letter and a mark, which then belongs to what follows."""
    changed = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    changed = [c for c in changed if unicodedata.normalize("NFC", c) != c]
    assert "\u0958" in changed and len(changed) > 1000
    texts = [f"{a}{c}{b}" for c in changed for a, b in (("", ", x"), ("b", ". y z"), ("\u0915 ", "e, "), (". ", "."))]
    # Letters that later marks compose with, and all marks of canonical class over 0.
    marks = [chr(c) for c in range(0x300, 0x3000) if unicodedata.combining(chr(c))]
    texts += [f"{a}{m}. {a.upper()}{m}, x" for m in marks for a in ("a", "\u0915", "\u05e9")]
    check(path, texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_letter_before_a_mark(path):
    """All letters and digits of the first plane, with each of the marks that end a chunk."""
    signs = [chr(c) for c in range(0x10000) if chr(c).isalnum() or unicodedata.category(chr(c))[0] in "LN"]
    texts = [f"x{c}{mark} {c}{mark}" for at, c in enumerate(signs) for mark in ".,;:!?"[at % 6]]
    check(path, texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ordinary_texts(path):
    draw = random.Random(9)
    parts = ["word", "Word", "\u00c9t\u00e9", "it's", "don't", "x-y", "3.5", "10,000", "A.", "b,", "(c)", "\u201cq\u201d", "wait!", "so?",
             "a;", "b:", "...", "?!", "e.g.,", "\nNew", "end.\n", "\u65e5\u672c\u3002", "'ll", "d'", "\u0130x.", "\u00bd.", "\u216b,", "\u2460!"]
    check(path, [" ".join(draw.choices(parts, k=draw.randint(0, 12))) for _ in range(4000)])


def check(path, texts):
    model = ChunkEncoder(path, cache_limit=5000)
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for at in range(0, len(texts), 1000):
        ids, counts = model.encode(pa.array(texts[at : at + 1000]))
        want = [x.ids for x in whole[at : at + 1000]]
        got = np.split(ids, np.cumsum(counts)[:-1])
        assert [list(g) for g in got] == want


def test_full_cache_starts_anew():
    model = ChunkEncoder(BYTES, cache_limit=3)
    for text in ("a b c d e f", "f e d c b a", "a b c d e f"):
        ids, _ = model.encode(pa.array([text]))
        assert ids.tolist() == encoded(BYTES, text)


def test_heap_merges_count_the_library_s_tokens():
    draw = random.Random(8)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 30))) for _ in range(3000)]
    texts.append("ab" * 50_000)
    whole = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    assert MergeCounter(BYTES).counts(pa.array(texts)).tolist() == [len(x.ids) for x in whole]


def test_count_tokens(documents, odd_rows):
    docs = documents(odd_rows, extra=("id", "n_tokens", "over_limit"))
    found = token_counts.count_tokens(docs, BYTES, limit=3).collect()
    want = [
        (i, len((text or "").encode()), len(encoded(BYTES, text)), len(encoded(BYTES, text)) > 3)
        for i, text in odd_rows
    ]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(documents([]), BYTES).count() == 0


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 4000])
def test_codes_give_any_token(size):
    draw = np.random.default_rng(size)
    ids = (draw.integers(0, 1 << 32, size) >> draw.integers(0, 32, size)).astype(np.uint32)
    book = token_files.CodeBook(token_files.encode_codes(ids))
    assert len(book) == size and np.array_equal(book.span(0, size), ids)
    for at in draw.integers(0, size, 100 if size else 0).tolist():
        assert book.token(at) == ids[at]
        assert np.array_equal(book.span(at, min(size, at + 77)), ids[at : at + 77])


def test_token_files(spark, documents, odd_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    rows = odd_rows + [(100 + i, "word " * (i % 40)) for i in range(300)]
    docs = documents(rows, extra=("id", "start", "ids"))
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, path, WORDS, partitions=5)
    found = [tuple(row) for row in token_files.read_token_files(spark, path).collect()]
    assert len(found) == len(rows)
    found.sort(key=lambda row: row[1])
    names = [row[0] for row in found]
    assert names == sorted(names, key=lambda name: (name is not None, name))
    texts, at = {}, 0
    for name, text in rows:
        texts.setdefault(name, []).append(text)
    for name, start, ids in found:
        assert start == at
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids in [encoded(WORDS, text) + [1] for text in texts[name]]
        at += len(ids)


def test_empty_token_files(spark, documents, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(documents([]), path, WORDS)
    assert token_files.read_token_files(spark, path).count() == 0


@pytest.mark.parametrize("count", [0, 1, 7, 3000, 60000])
def test_plan_holds_every_piece_close_to_the_bound(count):
    draw = np.random.default_rng(count)
    lengths = np.clip(draw.lognormal(6.3, 1, count), 1, 2048).astype(int)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    placed, sequences = {}, 0
    for run, times in packing.plan_packing(histogram):
        assert sum(run) <= 2048
        sequences += times
        for length in run:
            placed[length] = placed.get(length, 0) + times
    assert placed == histogram
    assert sequences <= 1.01 * (lengths.sum() / 2048) + 1


def test_least_squares_is_optimal():
    ways = packing.patterns(8, 3)
    target = np.array([5.0, 3, 0, 7, 1, 0, 2, 4])
    fitted = packing.nonnegative_fit([tuple(p - 1 for p in way) for way in ways], target)
    matrix = np.zeros((8, len(ways)))
    for column, way in enumerate(ways):
        for part in way:
            matrix[part - 1, column] += 1
    slope = matrix.T @ (target - matrix @ fitted)
    assert (fitted >= 0).all() and slope.max() < 1e-6 and np.abs(slope[fitted > 0]).max() < 1e-6


def test_pack_documents(spark, documents, odd_rows):
    rows = odd_rows + [(50 + i, "same words " * 30) for i in range(200)]
    docs = documents(rows, extra=("length", "sequence_id", "offset", "piece"))
    found = packing.pack_documents(docs, BYTES).collect()
    sequences, pieces = {}, {}
    for row in found:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
        pieces.setdefault(row.doc_id, []).append(row)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and 1 <= length <= 2048
            at += length
        assert at <= 2048
    texts = {}
    for name, text in rows:
        texts.setdefault(name, []).append(np.array(encoded(BYTES, text) + [0], "<u4"))
    assert set(texts) == set(pieces)
    for name, many in texts.items():
        want = []
        for ids in many:
            first = (len(ids) - 1) % 2048 + 1
            cuts = [0, *range(first, len(ids) + 1, 2048)]
            want += [(n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((p.piece, p.start, p.length, p.ids_crc32) for p in pieces[name]) == sorted(want)
    total = sum(len(ids) for many in texts.values() for ids in many)
    assert len(sequences) <= total / 2048 + 2
    assert packing.pack_documents(documents([]), BYTES).count() == 0


def test_pieces_carry_ids(documents):
    rows = packing.token_pieces(documents([(1, "one two three")]), BYTES, with_ids=True).collect()
    assert np.frombuffer(rows[0].ids, "<u4").tolist() == encoded(BYTES, "one two three") + [0]
