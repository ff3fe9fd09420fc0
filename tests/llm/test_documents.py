"""Language, quality, near-duplicates, decontamination and the pipeline."""

import random
import zlib
from math import log2

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from roadpulse.llm import decontaminate, language_id, quality, simhash
from roadpulse.llm.language_id import CostTables, padded

VOWELS, WORDS = "aeiou", {}


def sentence(draw, letters, count):
    return " ".join(
        "".join(draw.choice(letters) + draw.choice(VOWELS) for _ in range(draw.randint(1, 4)))
        for _ in range(count)
    )


# --- language ID ---------------------------------------------------------------------


def code_length(text, counts, order=3):
    """Bits by walking the contexts of each byte."""
    symbols = [256] * order + list(text.encode())
    total = 0.0
    for at in range(order, len(symbols)):
        for size in range(order, -1, -1):
            seen = counts.get(tuple(symbols[at - size : at]))
            if not seen:
                continue
            n, kinds = sum(seen.values()), len(seen)
            if symbols[at] in seen:
                total -= log2(seen[symbols[at]] / (n + kinds))
                break
            total -= log2(kinds / (n + kinds))
        else:
            total += 8
    return total


def test_tables_give_exact_code_lengths(monkeypatch):
    corpus = {"a": ["abab cde", "abc!"], "b": ["xyz xyz", "abé xy"]}
    trees, rows = {}, []
    for number, (lang, texts) in enumerate(corpus.items()):
        counts = {}
        for text in texts:
            symbols = [256] * 3 + list(text.encode())
            for at in range(3, len(symbols)):
                for size in range(4):
                    seen = counts.setdefault(tuple(symbols[at - size : at]), {})
                    seen[symbols[at]] = seen.get(symbols[at], 0) + 1
        trees[lang] = counts
        codes, times = language_id._grams(pa.array(texts))
        rows += [(number, code, n) for code, n in zip(codes, times)]
    number, codes, times = (np.array(column) for column in zip(*rows))
    model = CostTables(tuple(corpus), number, codes, times.astype(float))
    texts = ["abab", "xyz", "", "q!é zzz", "abc xyz" * 50, "日本"]
    want = [[code_length(text, trees[lang]) for lang in corpus] for text in texts]
    assert np.allclose(model.code_lengths(pa.array(texts)), want, rtol=1e-5)
    sparse = language_id.SparseCosts(tuple(corpus), number, codes, times.astype(float))
    assert np.allclose(sparse.code_lengths(pa.array(texts)), want, rtol=1e-9)
    monkeypatch.setattr(language_id, "CELLS", 5)
    assert np.allclose(sparse.code_lengths(pa.array(texts)), want, rtol=1e-9)


def test_many_languages_are_all_learned(documents, monkeypatch):
    """More languages than dense tables hold, each with words of its own."""
    monkeypatch.setattr(language_id, "SAMPLE_TOTAL", 2000)
    draw = random.Random(5)
    letters = "bcdfghjklmnpqrstvwxz"
    alphabets = ["".join(draw.sample(letters, 5)) for _ in range(300)]
    rows = [(10 * i + j, sentence(draw, a, 30), f"l{i}") for i, a in enumerate(alphabets) for j in range(8)]
    learned = [row for row in rows if zlib.crc32(str(row[0]).encode()) % 3 != 1]
    found = language_id.identify(documents(rows)).collect()
    names = {f"l{i}": i for i in range(300)}
    known = {row[2] for row in learned}
    right = [row.lang_pred == f"l{row.doc_id // 10}" for row in found if f"l{row.doc_id // 10}" in known]
    assert len({row.lang_pred for row in found}) > 256 and set(row.lang_pred for row in found) <= set(names)
    assert sum(right) > 0.85 * len(right)


def test_texts_are_padded_apart():
    symbols, places, bounds = padded(pa.array(["ab", "", "c"]))
    assert symbols.tolist() == [256] * 3 + [97, 98] + [256] * 6 + [99]
    assert places.tolist() == [3, 4, 11] and bounds.tolist() == [0, 2, 2, 3]


@pytest.fixture
def spoken(odd_rows):
    draw = random.Random(4)
    kinds = {"xx": "bdgkl", "yy": "mnprs", "zz": "tvwxz"}
    rows = []
    for i in range(300):
        lang = draw.choice(list(kinds))
        rows.append((1000 + i, sentence(draw, kinds[lang], draw.randint(2, 40)), lang))
    return rows + [(*row, None) for row in odd_rows] + [rows[0], (5000, None, "xx")]


def test_language(documents, spoken):
    docs = documents(spoken, extra=("lang_pred", "score", "held_out", "draw", "rank"))
    found = language_id.identify(docs).collect()
    assert len(found) == len(spoken)
    truth = {row[0]: row[2] for row in spoken if row[0] and row[0] >= 1000}
    texts = {row[0]: row[1] for row in spoken}
    tested = right = 0
    for row in found:
        held = zlib.crc32(str(row.doc_id if row.doc_id is not None else "").encode()) % 3 == 1
        assert row.held_out == held and 0 <= row.score <= 1
        text = texts[row.doc_id] or ""
        assert (row.lang_pred == "und") == (not any(char.isalpha() for char in text))
        if held and row.doc_id in truth and text:
            tested, right = tested + 1, right + (row.lang_pred == truth[row.doc_id])
    assert tested > 60 and right >= 0.97 * tested


def test_language_without_anything_to_learn(documents):
    found = language_id.identify(documents([(1, "some text"), (2, None)])).collect()
    assert {(row.lang_pred, row.score) for row in found} == {("und", 0.0)}
    assert language_id.identify(documents([])).count() == 0


# --- quality -------------------------------------------------------------------------


@pytest.fixture
def judged(spark, documents, odd_rows):
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        text = sentence(draw, "bdgkl", 60)
        text = text if good else text.upper().replace(" ", "!! ")
        source = "clean" if good != (draw.random() < 0.2) else "dump"
        rows.append((1000 + i, text, "en", source, len(text)))
        if i % 2:
            labels.append((1000 + i, int(good), 0))
    labels += [(None, 1, 0), (1001, None, 1), (99999, 0, 0), labels[0]]
    docs = documents(rows + list(odd_rows), extra=("id", "label", "keep", "score", "draw"))
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality(judged):
    docs, labels = judged
    found = quality.score_documents(docs, labels).collect()
    assert len(found) == docs.count()
    rows = [row for row in found if row.doc_id is not None and row.doc_id >= 1000]
    right = sum(row.keep == ((row.doc_id - 1000) % 3 > 0) for row in rows)
    assert right >= 0.97 * len(rows)
    assert all(0 <= value <= 1 for row in found for value in row[1:4])
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = sorted(row.doc_id or 0 for row in found if row.keep)
    assert sorted(row.doc_id or 0 for row in kept.collect()) == want


def test_repeated_rows_do_not_crowd_out_others(spark):
    """A bounded draw holds every different row before any row twice, whatever the order."""
    rows = spark.range(50).selectExpr("xxhash64(id) AS draw", "cast(id % 2 AS int) AS label")
    hot = spark.range(5000).selectExpr("xxhash64(7L) AS draw", "1 AS label")
    found = quality._least(rows.union(hot).repartition(7), ["draw", "label"], 60).collect()
    assert len(found) == 50 and set(found) == set(rows.collect())
    few = [row.draw for row in quality._least(rows.union(hot), ["draw", "label"], 10).collect()]
    assert few == sorted(row.draw for row in rows.collect())[:10]


def test_quality_with_a_hot_labelled_row(judged, monkeypatch):
    docs, labels = judged
    monkeypatch.setattr(quality, "LABELLED", 250)
    monkeypatch.setattr(quality, "EXCHANGED", 40)
    hot = docs.where("doc_id = 1003").selectExpr("*", "explode(sequence(1, 500)) AS copy").drop("copy")
    found = quality.score_documents(docs.union(hot), labels).collect()
    rows = [row for row in found if row.doc_id is not None and row.doc_id >= 1000 and row.doc_id != 1003]
    right = sum(row.keep == ((row.doc_id - 1000) % 3 > 0) for row in rows)
    assert right >= 0.95 * len(rows)


def test_quality_without_labels(judged):
    docs, labels = judged
    for few in (labels.limit(0), labels.where("quality = 1")):
        assert {row.score for row in quality.score_documents(docs, few).collect()} == {1.0}
        assert quality.keep_good(docs, few).count() == docs.count()
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_regression_matches_separable_and_constant_views():
    rows = np.array([[0.0, 1], [1, 1], [2, 1], [3, 1]] * 10)
    model = quality.Logistic.fit(rows, (rows[:, 0] > 1).astype(float))
    assert ((model.margin(rows) > 0) == (rows[:, 0] > 1)).all()
    flat = quality.Logistic.fit(np.zeros((8, 2)), np.array([0.0, 1] * 4))
    assert np.allclose(flat.margin(np.zeros((2, 2))), 0, atol=1e-6)


# --- near-duplicates -----------------------------------------------------------------


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = [p for p in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if p]
    grams = [" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    bits = [sum(h >> place & 1 for h in hashes) * 2 > len(hashes) for place in range(64)]
    return sum(1 << place for place, one in enumerate(bits) if one)


def test_fingerprints(odd_rows):
    for _, text in odd_rows:
        text = (text or "")[:5000]
        got = simhash.fingerprint(text.encode()) % (1 << 64)
        assert got == slow_fingerprint(text), text[:40]


def roots(values, distance=2):
    values = sorted(set(values))
    parent = {value: value for value in values}

    def root(value):
        while parent[value] != value:
            value = parent[value]
        return value

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) % (1 << 64)).bit_count() <= distance:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {value: root(value) for value in values}


@pytest.mark.parametrize("crowd", [1, 64])
def test_links_connect_all_close_prints(spark, crowd):
    draw = random.Random(6)
    values = [draw.getrandbits(64) for _ in range(60)]
    for _ in range(400):
        value = draw.choice(values)
        for _ in range(draw.randint(1, 3)):
            value ^= 1 << draw.randrange(64)
        values.append(value)
    # A dense cloud: many values that differ in a few chosen bits.
    soft, base = draw.sample(range(64), 9), draw.getrandbits(64)
    values += [base ^ sum(1 << b for b in soft if draw.random() < 0.5) for _ in range(300)]
    values = sorted({simhash._signed(value) for value in values})
    prints = spark.createDataFrame([(value,) for value in values], "fp bigint")
    found = {row.node: row.root for row in simhash.components(simhash.close_links(prints, crowd=crowd)).collect()}
    want = roots(values)
    assert {value: found.get(value, value) for value in values} == want


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    found = simhash.components(links).collect()
    assert {row.root for row in found} == {0} and len(found) == 200
    assert simhash.components(links.limit(0)).count() == 0


def test_near_duplicates(documents, odd_rows):
    draw = random.Random(7)
    text = sentence(draw, "bdgkl", 400)
    near = text.replace(text.split()[200], "other", 1)
    rows = [*odd_rows, (70, text), (60, near), (80, text), (90, sentence(draw, "mnprs", 50))]
    docs = documents(rows, extra=("fp", "id", "component_id", "fingerprint"))
    found = simhash.near_duplicates(docs).collect()
    prints = {(i, slow_fingerprint(t)) for i, t in rows if i != 5}
    assert prints <= {(row.doc_id, int(row.fingerprint, 16)) for row in found}
    root = roots([int(row.fingerprint, 16) for row in found])
    least = {}
    for row in found:
        if row.doc_id is not None:
            at = root[int(row.fingerprint, 16)]
            least[at] = min(least.get(at, row.doc_id), row.doc_id)
    assert len(found) == len(rows)
    assert all(row.component_id == least.get(root[int(row.fingerprint, 16)]) for row in found)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [row.doc_id for row in kept.collect()]
    alone = len(set(root.values()) - set(least))
    assert sorted(i for i in ids if i is not None) == sorted(least.values()) and ids.count(None) == alone
    assert simhash.near_duplicates(documents([])).count() == 0


def test_stage_keeps_one_row_of_each_component(spark, documents, odd_rows):
    """Equal rows, rows that share an id, no ids, and columns with the names in use."""
    draw = random.Random(17)
    texts = [sentence(draw, "bdgklmnprs", 40) for _ in range(30)]
    rows = [(draw.choice([None, *range(25)]), draw.choice([None, "", *texts])) for _ in range(160)]
    rows += rows[:30] + list(odd_rows)
    docs = documents(rows, extra=("_id", "none", "component_id", "fp", "count"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    root = roots([slow_fingerprint(text) for _, text in rows if len(text or "") < 1000] + [simhash.fingerprint(odd_rows[5][1].encode()) % (1 << 64)])
    members = {}
    for doc, text in set(rows):
        members.setdefault(root[simhash.fingerprint((text or "").encode()) % (1 << 64)], set()).add((doc, text))
    got = [(row.doc_id, row.text) for row in kept.collect()]
    assert len(got) == len(members) and set(got) <= set(rows)
    for group in members.values():
        (stays,) = [row for row in got if row in group]
        ids = [doc for doc, _ in group if doc is not None]
        assert stays[0] == (min(ids) if ids else None)


# --- decontamination -----------------------------------------------------------------


def slow_align(passage, item):
    table = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(passage):
            same = 2 if a == b and a > 0 else -1
            table[i + 1][j + 1] = max(0, table[i][j] + same, table[i][j + 1] - 1, table[i + 1][j] - 1)
    return max(map(max, table))


def test_alignment():
    draw = random.Random(9)
    for _ in range(200):
        passage = [draw.randint(0, 4) for _ in range(draw.randint(1, 30))]
        item = [draw.randint(1, 4) for _ in range(draw.randint(1, 15))]
        score, begin, end = decontaminate.align(np.array(passage), np.array(item))
        assert score == slow_align(passage, item)
        assert score == slow_align(passage[begin:end], item)


def edited(draw, text, rate):
    out = []
    for word in text.split():
        chance = draw.random()
        if chance < rate / 2:
            out.append("edit")
        elif chance > rate:
            out.append(word)
    return " ".join(out)


@pytest.fixture
def leaky(spark, documents, odd_rows):
    draw = random.Random(10)
    items = [(i, sentence(draw, "bdgkl", 30)) for i in range(20)]
    rows, want = [], set()
    for i in range(120):
        filler = sentence(draw, "bdgkl", 150)
        if i % 3 == 0:
            item = draw.choice(items)
            text = edited(draw, item[1], 0.15) if i % 2 else item[1].upper().replace(" ", ", ")
            filler = filler[:300] + " " + text + " " + filler[300:]
            want.add((1000 + i, item[0]))
        rows.append((1000 + i, filler))
    # One item in a third of all documents.
    hot = sentence(draw, "mnprs", 40)
    rows += [(2000 + i, sentence(draw, "bdgkl", 20) + " " + hot) for i in range(60)]
    want |= {(2000 + i, 50) for i in range(60)}
    items += [(50, hot), (51, None), (52, ""), (53, "two words"), (None, hot), items[0]]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents([*odd_rows, *rows, rows[0]], extra=("item_id", "item", "codes", "score"))
    return docs, benchmark.selectExpr("*", "'clash' AS doc_id"), want


@pytest.mark.parametrize("slice_words", [4_000_000, 300])
def test_leaks(leaky, slice_words):
    docs, benchmark, want = leaky
    found = decontaminate.find_leaks(docs, benchmark, slice_words).collect()
    assert {(row.doc_id, row.item_id) for row in found} == want and len(found) == len(want)
    assert all(row.first_word <= row.last_word for row in found)


def test_often_copied_passages_meet_their_item(spark, documents):
    """Each intact n-gram is in over 1000 passages, and each neighbour of one is rarer."""
    draw = random.Random(12)
    item = [f"w{at}" for at in range(30)]
    copy = [word if at % 5 != 4 else "edit" for at, word in enumerate(item)]
    other = [draw.choice(item) for _ in range(1200)]
    rows = [(at, f"{word} {' '.join(copy)} x{at}") for at, word in enumerate(other)]
    rows.append((5000, " ".join(item)))
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = decontaminate.find_leaks(documents(rows), benchmark).collect()
    assert sorted(row.doc_id for row in found) == [*range(1200), 5000]


def contained(docs, items):
    """Pairs that share a seed and align well enough, by comparing all pairs in full."""
    found = {}
    numbers = {}
    code = lambda text: np.array([numbers.setdefault(w, len(numbers) + 1) for w in decontaminate.words(text or "")])
    for item, text in items:
        inner = code(text)
        size = min(len(inner), decontaminate.SEED_WORDS)
        seeds = {tuple(inner[i : i + size]) for i in range(len(inner) - size + 1)} if size else set()
        for doc, words in docs:
            outer = code(words)
            grams = {tuple(outer[i : i + size]) for i in range(len(outer) - size + 1)} if size else set()
            if seeds & grams:
                score = slow_align(outer, inner)
                if score >= 2 * decontaminate.needed_words(len(inner)):
                    found[doc, item] = score
    return found


def test_leaks_are_those_of_all_pairs(spark, documents):
    """Items of 1 to 3 words, every fourth word edited, insertions, several items and copies."""
    draw = random.Random(21)
    names = [f"w{i}" for i in range(70)]
    some = lambda n: [draw.choice(names) for _ in range(n)]
    items = [some(n) for n in (1, 2, 2, 3, 3, 4, 5, 8, 12, 20, 30, 30, 45)]
    items[0] = ["single"]
    rows = []
    for at in range(160):
        text = some(draw.randint(0, 40))
        for _ in range(draw.randint(0, 2)):
            item = list(draw.choice(items))
            kind = draw.randrange(5)
            if kind == 1:
                item = [w if i % 4 != 3 else "edit" for i, w in enumerate(item)]
            elif kind == 2:
                item = [x for i, w in enumerate(item) for x in ([w, "more"] if i % 3 == 2 else [w])]
            elif kind == 3:
                item = [w for w in item if draw.random() < 0.8]
            elif kind == 4:
                item = item[len(item) // 3 :]
            text += item + some(draw.randint(0, 30))
        rows.append((at, " ".join(text)))
    listed = [(i, " ".join(item)) for i, item in enumerate(items)]
    want = contained(rows, listed)
    assert {item for _, item in want} >= {0, 1, 3, 5, 8, 10, 12}
    benchmark = spark.createDataFrame(listed, "item_id bigint, text string")
    found = decontaminate.find_leaks(documents(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == set(want)
    # The seed that decides is that of some copy: a good score, and the best one mostly.
    assert all(2 * decontaminate.needed_words(r.item_words) <= r.score <= want[r.doc_id, r.item_id] for r in found)
    assert sum(r.score == want[r.doc_id, r.item_id] for r in found) > 0.9 * len(found)


def test_rarest_seed_decides_first(monkeypatch):
    """The counts choose which seed is aligned first; what is found stays the same."""
    item = [f"w{i}" for i in range(20)]
    vocabulary = decontaminate.Vocabulary([" ".join(item)])
    # First the item's words out of order, of which three are intact.
    text = vocabulary.code(item[:3] + item[:2:-1] + ["x"] * 300 + item + ["x"] * 300 + item[:3])
    at, numbers = vocabulary.hits(text)
    aligned = []
    plain = decontaminate.align
    monkeypatch.setattr(decontaminate, "align", lambda a, b: aligned.append(1) or plain(a, b))
    rare_copy = np.full(len(vocabulary.grams), 1)
    rare_copy[numbers[at == 0]] = 1000
    assert vocabulary.found(text, rare_copy) == [(0, 40, 320, 340)] and len(aligned) == 1
    aligned.clear()
    rare_start = np.full(len(vocabulary.grams), 1000)
    rare_start[numbers[at == 0]] = 1
    assert vocabulary.found(text, rare_start) == [(0, 40, 320, 340)] and len(aligned) == 2


def test_leaks_are_dropped(leaky):
    docs, benchmark, want = leaky
    kept = decontaminate.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    bad = {pair[0] for pair in want}
    expected = [row.doc_id for row in docs.collect() if row.doc_id not in bad]
    assert sorted(map(str, expected)) == sorted(str(row.doc_id) for row in kept.collect())
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0


# --- pipeline ------------------------------------------------------------------------


def test_pipeline(spark, judged, spoken, leaky, tmp_path):
    docs, labels = judged
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    tables = {"documents": docs.select(columns), "labels": labels, "benchmark": leaky[1]}
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    sf_dir = str(tmp_path)
    stored = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, stored, sf_dir)
        before = {row.doc_id for row in stored.collect()}
        assert {row.doc_id for row in result.collect()} <= before
        if number < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == columns
            result.write.parquet(str(tmp_path / name))
            stored = spark.read.parquet(str(tmp_path / name))
            assert stored.count() > 0
        else:
            assert {row.doc_id for row in result.collect()} == before
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.select(result.columns[:5]).collect()), key=str) == sorted(
        map(tuple, result.select(result.columns[:5]).collect()), key=str
    )


def test_pipeline_of_nothing(spark, judged, leaky, tmp_path):
    docs, labels = judged
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, table in {"documents": docs.select(columns), "labels": labels, "benchmark": leaky[1]}.items():
        table.limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
