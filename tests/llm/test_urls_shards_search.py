import math
import random
import zlib

import numpy as np
import pytest

from roadpulse.llm import sharding, topk, url_filter

URLS = [
    ("https://Sub.Example.NET/en/1?x=1", "sub.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://a.org/fr/?porn", "a.org", "/fr/", "org/fr/", "allow"),
    ("http://a.org/en/porn", "a.org", "/en/porn", None, "block"),
    ("http://a.org/en/pornography", "a.org", "/en/pornography", None, "allow"),
    ("http://a.org/PORN-1", "a.org", "/PORN-1", None, "block"),
    ("http://free.org/casino/poker", "free.org", "/casino/poker", None, "block"),
    ("http://free.org/free/free", "free.org", "/free/free", None, "allow"),
    ("example.com/de/", "", "", None, "allow"),
    ("http://www.example.com/de", "www.example.com", "/de", None, "allow"),
    ("http://x.example.com/de/#a", "x.example.com", "/de/", "example.com/de/", "block"),
    ("://org/fr/", "org", "/fr/", "org/fr/", "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_urls(spark):
    rows = [(i, url, None) for i, (url, *_) in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages = pages.selectExpr("*", "'clash' AS host", "'clash' AS weight", "'clash' AS text")
    found = sorted(map(tuple, url_filter.judge_urls(pages).collect()))
    assert [row[1:5] for row in found] == [tuple(want[1:]) for want in URLS]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_long_url_and_own_vocabulary(spark):
    url = "http://h.com/" + "x" * 100_000 + "/bad"
    pages = spark.createDataFrame([(None, url)], "page_id bigint, url string")
    found = url_filter.judge_urls(pages, rules=(), strict=("BAD",), soft=()).collect()
    assert (found[0].rule, found[0].verdict, found[0].strict_hits) == (None, "block", 1)
    assert url_filter.judge_urls(pages, rules=(), strict=(), soft=()).first().verdict == "allow"


@pytest.mark.parametrize("copies", [3, 400])
def test_shards_are_even(documents, odd_rows, copies):
    draw = random.Random(1)
    rows = [(1000 + i, "w" * draw.randint(1, 400)) for i in range(3000)]
    rows += [(9000 + i, "a copied text " * 20) for i in range(copies)]
    rows += [row for row in odd_rows if not row[1] or len(row[1]) < 1000]
    docs = documents(rows, extra=("shard", "range", "size", "key"))
    found = sharding.assign_shards(docs).collect()
    assert len(found) == len(rows)
    bytes_, slots, homes = {}, {}, {}
    for row in found:
        bytes_[row.shard] = bytes_.get(row.shard, 0) + row.size
        slots.setdefault(row.shard, []).append(row.slot)
        homes.setdefault(row.text_crc32, set()).add(row.shard)
    assert sorted(bytes_) == list(range(8))
    assert max(bytes_.values()) < 1.03 * min(bytes_.values())
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())
    want = sorted((i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in found) == want
    # Equal texts are together unless they are more than a range may hold.
    held = {}
    for row in found:
        held[row.text_crc32] = held.get(row.text_crc32, 0) + row.size
    share = sum(bytes_.values()) / (8 * sharding.RANGES_PER_SHARD)
    assert all(len(homes[text]) == 1 for text, size in held.items() if size <= share)


def test_shards_of_few_and_no_rows(spark, documents, tmp_path):
    assert sharding.assign_shards(documents([])).count() == 0
    placed = sharding.assign_shards(documents([(1, "a"), (2, None)]))
    assert sorted(row.slot for row in placed.collect()) == [0, 0]
    sharding.write_shards(placed, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 2


def in_range(number):
    return max(-(1 << 63), min(topk.LONGEST, number))


def brute(vectors, k, every):
    whole = {}
    for id_, vector in vectors:
        if id_ is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole[id_] = [in_range(math.floor(256 * x)) for x in vector]
    rows = []
    for q, a in whole.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in whole.items() if v != q)
            rows += [(q, rank + 1, v, in_range(-s)) for rank, (s, v) in enumerate(scores[:k])]
    return sorted(rows)


@pytest.mark.parametrize("block", [16, 4096])
def test_top_neighbours(spark, block):
    draw = random.Random(3)
    vectors = [(i, [draw.gauss(0, 0.2) for _ in range(12)]) for i in range(150)]
    vectors += [(200 + i, [0.5] * 12) for i in range(40)]
    vectors += [(300, None), (301, [None] * 12), (302, [float("nan")] * 12), (303, [float("inf")] + [0.0] * 11)]
    vectors += [(304, []), (305, [1.0, 2.0]), (None, [1.0] * 12), (306, [3e30] + [-0.001] * 11)]
    vectors += [(310, [0.0] * 12), (0, vectors[0][1])]
    table = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    table = table.selectExpr("*", "'clash' AS weights", "'clash' AS rank")
    import struct

    single = lambda x: x if x is None else struct.unpack("f", struct.pack("f", x))[0]
    exact = [(i, None if v is None else [single(x) for x in v]) for i, v in vectors]
    found = topk.top_neighbours(table, block=block, every=10)
    assert sorted(map(tuple, found.collect())) == brute(exact, 5, 10)
    assert topk.top_neighbours(table.limit(0)).count() == 0


def test_fewer_neighbours_than_asked(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (2, [2.0])], "vec_id bigint, embedding array<float>")
    found = sorted(map(tuple, topk.top_neighbours(table).collect()))
    assert found == [(0, 1, 2, 131072), (0, 2, 1, 65536)]


def test_copies_of_queries_are_not_broadcast(spark):
    """Queries are copied to every block of documents; so many rows must not pass through the driver."""
    draw = random.Random(5)
    vectors = [(i, [draw.randint(-256, 256) / 256 for _ in range(32)]) for i in range(400)]
    table = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    # More than the queries, less than the documents.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        found = topk.top_neighbours(table, block=16, every=100)
        assert sorted(map(tuple, found.collect())) == brute(vectors, 5, 100)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Generate explode" in plan
    above = []
    for line in plan.split("== Initial Plan ==")[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, node) for d, node in above if d < depth] + [(depth, line)]
        if "Generate explode" in line:
            assert not any("BroadcastExchange" in node for _, node in above)


@pytest.mark.parametrize("scale", [1.0, 3e5, 1e9, 1e13])
def test_components_of_any_size_are_exact(spark, scale):
    draw = np.random.default_rng(4)
    rows = [(i, (scale * draw.normal(0, 1, 7)).tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want, cut = [], lambda x: max(-topk.LONGEST, min(topk.LONGEST, x))
    for query in range(0, 300, 50):
        scored = sorted((-sum(a * b for a, b in zip(whole[query], v)), i) for i, v in whole.items() if i != query)
        want += [(query, rank, i, cut(-score)) for rank, (score, i) in enumerate(scored[:5], 1)]
    found = topk.top_neighbours(table, block=64).collect()
    assert sorted(map(tuple, found)) == want


def test_terms_are_split_by_the_kth_best():
    """With a floor only some terms are traversed, and some documents are never scored."""
    draw = np.random.default_rng(9)
    rows = np.where(draw.random((2000, 40)) < 0.1, draw.normal(0, 100, (2000, 40)), 0).astype(int)
    rows[:, 5:] //= 8
    postings = topk.Postings(np.arange(2000), rows)
    seen = []

    class Watched(list):
        def __getitem__(self, term):
            seen.append(term)
            return super().__getitem__(term)

    postings.lists = Watched(postings.lists)
    for at in range(40):
        query = rows[at]
        scores = rows @ query
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != at)[:5]
        want = [(-s, i) for s, i in want]
        assert postings.search(query, at, 5, None) == want
        all_terms = len(seen)
        # A floor that is the k-th best itself keeps its ties.
        assert postings.search(query, at, 5, want[-1][0]) == want
        if want[-1][0] > 0:
            assert len(seen) - all_terms < all_terms or (query != 0).sum() < 3
        assert postings.search(query, at, 5, want[0][0] + 1) == []
        seen.clear()


def test_vocabulary_of_a_table(spark):
    terms = [("Casino", 2), ("poker", 2), ("free", 1), ("free", 1), ("evil", None), ("worse", 9), ("", 5), (None, 5),
             ("never", 0), ("bet", 1), ("bet", 3)]
    table = spark.createDataFrame(terms, "term string, weight int")
    strict, soft = url_filter.read_vocabulary(table, 4)
    assert strict == ("evil", "worse") and soft == {"casino": 2, "poker": 2, "free": 1, "bet": 3}
    urls = ["http://a.b/casino-poker", "http://a.b/casino/free", "http://a.b/casino/casino", "http://a.b/EVIL",
            "http://a.b/bet-free", "http://a.b/bets-free", "http://a.b/p%6Fker/%43asino", "http://a.b/%E2%82/evil", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")

    def verdicts(**more):
        found = url_filter.judge_urls(pages, (), strict, soft, 4, **more).collect()
        return {row.page_id: (row.verdict, row.weight) for row in found}

    want = {0: ("block", 4), 1: ("allow", 3), 2: ("allow", 2), 3: ("block", 4), 4: ("block", 4), 5: ("allow", 1),
            6: ("allow", 0), 7: ("block", 4), 8: ("allow", 0)}
    assert verdicts() == want
    assert verdicts(decode=True) == want | {6: ("block", 4)}
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, soft={"x": 4}, soft_limit=4)
    assert url_filter.read_vocabulary(table.limit(0), 4) == ((), {})
