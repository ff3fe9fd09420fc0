"""Operator 2: weighted URL vocabulary.

Terms of the vocabulary are found in the lower-cased URL by an Aho-Corasick automaton. A
hit counts if no ASCII letter or digit stands directly before or after it. Strict terms
weigh as much as the limit, soft terms less, each with a weight of its own (1 by default); a
URL is rejected when its distinct hits reach the limit: one strict term, or several different
soft ones. A vocabulary can be given as a table, see ``read_vocabulary``; with ``decode``
terms are also found where ``%xx`` hides their letters.

Host rules come before that: a rule (host, path) fits its host and all subdomains if the
URL's path starts with the rule's. The longest rule wins, and its verdict stands.

A null URL, or one without ``://``, has an empty host and path, so no rule fits it; the
vocabulary still reads it (null: no hits). Each row is judged by itself; repeated rows,
null ids and other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words for sites that do not belong in training data.
STRICT_TERMS = (
    "porn", "porno", "xxx", "hentai", "xvideos", "xnxx", "camgirls", "viagra", "cialis",
    "sexcams", "onlinecasino", "warez", "keygen", "escorts", "milf",
)
SOFT_TERMS = (
    "adult", "bet", "betting", "bonus", "casino", "crack", "dating", "escort", "free",
    "gambling", "jackpot", "loan", "loans", "nude", "payday", "pharmacy", "pills", "poker",
    "replica", "sex", "sexy", "slots", "spam", "torrent", "download",
)
SOFT_LIMIT = 3

# (rule, verdict); a rule is a host directly followed by the start of a path.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


MOST_TERMS = 1_000_000

Weights = tuple[tuple[str, int], ...]


def weighted(soft: Sequence[str] | Mapping[str, int], limit: int = SOFT_LIMIT) -> Weights:
    """Soft terms with their weights, lower-cased; each has to be below the limit."""
    pairs = soft.items() if isinstance(soft, Mapping) else ((term, 1) for term in soft)
    made = {term.lower(): weight for term, weight in pairs}
    wrong = [term for term, weight in made.items() if not 0 < weight < limit]
    if wrong:
        raise ValueError(f"weights of soft terms must be from 1 to {limit - 1}: {wrong[:5]}")
    return tuple(made.items())


def read_vocabulary(table: DataFrame, limit: int = SOFT_LIMIT) -> tuple[tuple[str, ...], dict[str, int]]:
    """Strict terms, and soft terms with their weights, of a table with ``term`` and ``weight``.

    A weight of the limit or more, or none, makes a term strict; a term with several weights
    has the greatest. Null and empty terms and weights below 1 are left out. The terms go to
    every task, so a table of over ``MOST_TERMS`` is an error.
    """
    term = F.lower(F.col("term"))
    rows = table.where("term <> '' AND coalesce(weight, 1) >= 1").groupBy(term.alias("term"))
    rows = rows.agg(F.max(F.coalesce(F.col("weight"), F.lit(limit))).cast("int").alias("weight"))
    found = rows.limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"a vocabulary may have {MOST_TERMS} terms")
    strict = sorted(row["term"] for row in found if row["weight"] >= limit)
    return tuple(strict), {row["term"]: row["weight"] for row in found if row["weight"] < limit}


@lru_cache(maxsize=4)
def automaton(strict: tuple[str, ...], soft: Weights):
    import ahocorasick

    words = ahocorasick.Automaton()
    for term, weight in soft:
        words.add_word(term, (weight, term))
    for term in strict:
        words.add_word(term.lower(), (0, term.lower()))
    if len(words):
        words.make_automaton()
    return words


def _inside_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and text[at].isascii() and text[at].isalnum()


def hits(text: str, strict: tuple[str, ...], soft: Weights) -> tuple[int, int, int]:
    """How many different strict and soft terms stand in ``text`` as words, and what the
    soft ones weigh. A term that is both is strict."""
    words = automaton(strict, soft)
    found = set()
    if len(words):
        for last, (weight, term) in words.iter(text):
            if not _inside_word(text, last + 1) and not _inside_word(text, last - len(term)):
                found.add((weight, term))
    strict_hits = sum(weight == 0 for weight, _ in found)
    return strict_hits, len(found) - strict_hits, sum(weight for weight, _ in found)


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    url = F.col(url_col)
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    known = F.instr(url, "://") > 0
    host = F.when(known, lower_ascii(F.regexp_extract(rest, r"\A([^/?#]*)", 1)))
    path = F.when(known, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1))
    return pages.withColumns(
        {"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))}
    )


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct of the longest fitting ``rule`` and its ``verdict``, or null."""
    cases = None
    for rule, verdict in sorted(rules, key=lambda pair: (-len(pair[0]), pair[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        cases = F.when(fits, value) if cases is None else cases.when(fits, value)
    empty = F.lit(None).cast("struct<rule:string,verdict:string>")
    return empty if cases is None else cases.otherwise(empty)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] | Mapping[str, int] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
    id_col: str = "page_id",
    url_col: str = "url",
    decode: bool = False,
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``strict_hits``, ``soft_hits``
    and ``weight`` of each row. One pass, no shuffle."""
    kind = pages.schema[id_col].dataType.simpleString()
    strict, soft = tuple(strict), weighted(soft, soft_limit)
    slim = with_host_path(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")))
    slim = slim.withColumn("text", lower_ascii(F.coalesce("url", F.lit(""))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column("text").to_pylist()
            if decode:
                urls = [unquote(url, errors="replace").lower() for url in urls]
            found = [hits(url, strict, soft) for url in urls]
            yield pa.record_batch(
                {
                    **{name: batch.column(name) for name in ("id", "host", "path")},
                    "strict_hits": pa.array([x[0] for x in found], pa.int32()),
                    "soft_hits": pa.array([x[1] for x in found], pa.int32()),
                    "soft_weight": pa.array([x[2] for x in found], pa.int32()),
                }
            )

    read = slim.select("id", "host", "path", "text").mapInArrow(
        run, f"id {kind}, host string, path string, strict_hits int, soft_hits int, soft_weight int"
    )
    weight = F.col("strict_hits") * soft_limit + F.col("soft_weight")
    judged = read.withColumn("weight", weight).withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules))
    by_words = F.when(F.col("weight") >= soft_limit, "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", by_words).alias("verdict"),
        "strict_hits",
        "soft_hits",
        "weight",
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def judge_sql() -> str:
    """The query in SQL, each term by a pattern of its own."""

    def count(terms):
        return " + ".join(
            f"CAST(regexp_matches(t, '(^|[^0-9a-z]){term}([^0-9a-z]|$)') AS INT)" for term in terms
        )

    fits = []
    for rule, verdict in sorted(RULES, key=lambda pair: (-len(pair[0]), pair[0])):
        name, slash, start = rule.partition("/")
        test = (
            f"(host = {_quoted(name)} OR ends_with(host, {_quoted('.' + name)}))"
            f" AND starts_with(path, {_quoted(slash + start)})"
        )
        fits.append((test, rule, verdict))
    rule = " ".join(f"WHEN {test} THEN {_quoted(name)}" for test, name, _ in fits)
    verdict = " ".join(f"WHEN {test} THEN {_quoted(to)}" for test, _, to in fits)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate({{}}, '{letters}', '{letters.lower()}')"
    return f"""
        WITH cut AS (
            SELECT page_id, {lowered.format("coalesce(url, '')")} AS t,
                   CASE WHEN strpos(url, '://') > 0
                        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, t, {lowered.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), counted AS (
            SELECT *, CAST({count(STRICT_TERMS)} AS INT) AS strict_hits,
                   CAST({count(SOFT_TERMS)} AS INT) AS soft_hits
            FROM parts
        ), weighed AS (
            SELECT *, strict_hits * {SOFT_LIMIT} + soft_hits AS weight FROM counted
        )
        SELECT page_id, host, path, CASE {rule} END AS rule,
               CASE {verdict} WHEN weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
               strict_hits, soft_hits, CAST(weight AS INT) AS weight
        FROM weighed
    """
