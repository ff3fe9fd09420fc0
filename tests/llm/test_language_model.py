"""Operator 11: counts and add-one scores against plain loops, the network's normalisation,
its gain on rows it has not learned from, and the rows a plain computation gives."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from roadpulse.llm import language_model as lm


def tokens(text):
    lower = (text or "").encode().translate(lm.LOWER)
    return lower.split() + [lm.END]


def learned(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 != 2


def base_scores(rows):
    counts = Counter(w for doc, text, *_ in rows if learned(doc) for w in tokens(text))
    total, size = sum(counts.values()), len(counts)
    return total, [
        (
            doc,
            not learned(doc),
            len(tokens(text)),
            sum(counts[w] > 0 for w in tokens(text)),
            sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in tokens(text)),
        )
        for doc, text, *_ in rows
    ]


def check_base(found, rows):
    total, want = base_scores(rows)
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in found]
    order = lambda r: (str(r[0]), r[2:])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
    assert all(r.train_tokens == total and math.isfinite(r.score) and r.score < 0 for r in found)


def sentences(count):
    rng = np.random.default_rng(3)
    names = [["der", "die", "und"], ["the", "and", "of"]]
    stems = [["haus", "baum", "weg"], ["cat", "dog", "tree"]]
    rows = []
    for doc in range(count):
        lang = doc % 2
        rare = [f"{rng.choice(stems[lang])}{rng.integers(90)}{'ung' if lang == 0 else 'ing'}" for _ in range(20)]
        words = [str(rng.choice(names[lang])) if rng.random() < 0.6 else rare[i % 20] for i in range(40)]
        rows.append((doc, " ".join(words)))
    return rows


def test_odd_rows(documents, odd_rows):
    rows = odd_rows + [(9, "\u00a0 \u2003 x\x1cy\x0bz THE cat")]
    found = lm.score_texts(documents(rows, extra=("row", "held", "units", "rare", "word"))).collect()
    check_base(found, rows)


def test_empty_table(documents):
    assert lm.score_texts(documents([])).collect() == []


def test_no_learning_rows(documents):
    rows = [(doc, "some words") for doc in range(60) if not learned(doc)]
    found = lm.score_texts(documents(rows)).collect()
    assert rows and {(r.train_tokens, r.n_known, r.base_score) for r in found} == {(0, 0, 0.0)}
    assert all(r.score == pytest.approx(3 * math.log10(1 / 2), abs=0.2) for r in found)


def test_rare_words_by_join_are_those_by_broadcast(documents, monkeypatch):
    rows = sentences(200)
    monkeypatch.setattr(lm, "ROUNDS", 1)
    whole = {r.doc_id: tuple(r) for r in lm.score_texts(documents(rows)).collect()}
    few = lm.vocabulary

    def vocabulary(counts):
        made = few(counts, most=12)
        assert 0 < len(made.words) <= 12
        return made

    monkeypatch.setattr(lm, "vocabulary", vocabulary)
    found = lm.score_texts(documents(rows)).collect()
    check_base(found, rows)
    assert {r.doc_id for r in found} == set(whole)
    for row in found:
        assert tuple(row)[:5] == whole[row.doc_id][:5]


def test_gain_on_rows_not_learned_from(documents):
    found = lm.score_texts(documents(sentences(1500))).collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 100
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)


def test_probabilities_of_all_words_sum_to_one(spark, documents):
    docs = documents(sentences(300))
    slim = docs.selectExpr("doc_id AS row", "text", "false AS held")
    counts = lm.word_counts(slim)
    vocab = lm.vocabulary(counts, words=4, endings=3)
    model = lm.LogBilinear.untrained(vocab.unit_counts)
    rng = np.random.default_rng(1)
    model.values[:] += rng.normal(0, 0.3, len(model.values)).astype(np.float32)
    contexts = rng.integers(0, model.units, (5, model.context))
    chances = np.exp(model.log_probabilities(contexts))
    words = {bytes(r["word"]): r["n"] for r in counts.collect()}
    place = dict(zip(vocab.words, vocab.units))
    for row in chances:
        total, unseen = 0.0, set()
        for word, n in words.items():
            unit = place[word]
            share = (n + 1) / 10 ** vocab.shares[unit] if vocab.shares[unit] else 1.0
            total += row[unit] * share
            unseen.add(unit)
        for unit in unseen:
            if vocab.shares[unit]:
                total += row[unit] / 10 ** vocab.shares[unit]
        # Units that no word of the corpus has.
        total += sum(row[u] for u in range(1, model.units) if u not in unseen)
        assert total == pytest.approx(1.0, rel=1e-5)


def test_scores_are_those_of_a_plain_computation():
    rng = np.random.default_rng(2)
    model = lm.LogBilinear.untrained(rng.integers(1, 50, 30))
    model.values[:] += rng.normal(0, 0.5, len(model.values)).astype(np.float32)
    units, lengths = rng.integers(1, 30, 700), np.array([1, 0, 400, 299])
    contexts = lm.with_contexts(units, lengths, model.context)
    found = model.following(contexts, units)
    text_of = np.repeat(np.arange(4), lengths)
    for at in range(0, 700, 37):
        before = [
            units[at - b] if at - b >= 0 and text_of[at - b] == text_of[at] else lm.START_UNIT
            for b in range(1, model.context + 1)
        ]
        assert list(contexts[at]) == before
        guess = sum(model.inputs[u].astype(float) @ m for u, m in zip(before, model.matrices))
        scores = model.targets.astype(float) @ guess + model.bias
        scores[lm.START_UNIT] = -np.inf
        want = scores[units[at]] - np.log(np.exp(scores).sum())
        assert found[at] == pytest.approx(want, abs=1e-4)
    # Scores too large for plain exponentials are normalised all the same.
    model.bias[3] = 200
    assert np.exp(model.following(contexts, np.full(700, 3))) == pytest.approx(np.ones(700))


def test_noise_contrast_learns_the_conditional_frequencies():
    """After unit 3 comes 4 in three cases of four, else 5."""
    rng = np.random.default_rng(0)
    model = lm.LogBilinear.untrained(np.array([0, 0, 0, 400, 300, 100]))
    shares = lm.noise_shares(np.array([0, 0, 0, 400, 300, 100]))
    log_noise = np.log(lm.NOISE * shares).astype(np.float32)
    contexts = np.full((512, model.context), 3)
    for _ in range(300):
        units = rng.choice([4, 5], 512, p=[0.75, 0.25])
        model.learn(contexts, units, rng.choice(6, lm.NOISE, p=shares), log_noise)
    chances = np.exp(model.log_probabilities(contexts[:1]))[0]
    assert chances[4] == pytest.approx(0.75, abs=0.08) and chances[5] == pytest.approx(0.25, abs=0.08)


def test_pieces_of_a_long_text_keep_words_whole():
    text = b"  ".join(b"w%d" % i for i in range(5000)) + b"\n"
    parts = list(lm.pieces(text, 100))
    assert len(parts) > 100 and b"".join(parts) == text
    assert [w for part in parts for w in part.split()] == text.split()
    assert list(lm.pieces(b"x" * 1000, 100)) == [b"x" * 1000]
