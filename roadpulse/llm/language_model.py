"""Operator 11: language-model scores of whole texts by a log-bilinear neural model.

Words are counted over the whole corpus, so the vocabulary is open. What the network
predicts are *units*: the end of a text, the most frequent words, and for all other words
their ending (up to three bytes), as far as the ending is frequent. A word that is no unit
of its own has the probability of its unit times its smoothed share in the unit,
(c + 1) / (N + V + 1) with the count of the word, of all tokens and of all words there; one
part is left for words that were never seen. So the probabilities of all words after any
context sum to one.

The network is log-bilinear: a matrix for each place of the context maps the vector of the
unit there, their sum is the prediction, and a unit's score is the inner product with its
target vector plus a bias. It is trained in numpy by noise-contrastive estimation: the unit
that follows is told apart from units drawn by their frequency, and no sum over all units
is needed. Scoring normalises: batched matrix products give the scores of all units after
each context, and their log-sum is taken off.

Training passes over all learning rows once, in rounds. In a round each task trains on its
rows from the parameters of the round before; the parameters of all tasks, weighted by
their tokens, are summed in streams and averaged. Texts are read twice: for the counts,
and for a stored table of units. Counts of frequent words travel as a broadcast of at most
``FREQUENT`` words; all other words are joined with their counts by shuffle.

Null texts are empty: only the end is scored. A row without an id counts as one with an
empty id (it is learned from). Repeated rows are scored and learned from as often as they
occur. Equal counts go to the smaller word. Other columns are not read. Without learning
rows the units are about equally likely; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.arrow import text_slices
from roadpulse.llm.workers import kept
from roadpulse.session import materialize, scratch_path

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SPACE = b" \t\n\x0b\x0c\r"
END = b""
START_UNIT, END_UNIT, OTHER_UNIT = 0, 1, 2
ENDING = 3

# Settings of the model.
WORDS, ENDINGS = 127, 126
WIDTH, CONTEXT = 16, 4
ROUNDS, BATCH, NOISE = 4, 1024, 32
RATE = 0.1
# Bounds of memory: words in the broadcast, words counted at a time, bytes of a text and
# tokens that are worked on at a time.
FREQUENT = 1 << 18
COUNTED = 500_000
PIECE = 1 << 20
BLOCK = 1 << 8
STREAMS = 32
LEVELS = 64  # steps of a doubling by which frequent words are told from others


def held_out(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def pieces(text: bytes, most: int = PIECE) -> Iterator[bytes]:
    """A text in parts that end where a word ends, so that one very long text is never
    held as words."""
    start = 0
    while len(text) - start > most:
        places = (text.find(byte, start + most) for byte in (SPACE[i : i + 1] for i in range(6)))
        stop = min((place for place in places if place >= 0), default=-1)
        if stop < 0:
            break
        yield text[start:stop]
        start = stop
    yield text[start:]


# --- counts --------------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes; empty: the end), ``n`` in learning rows and ``every`` in all rows, of
    ``docs`` with ``text`` and ``held``."""

    def run(batches):
        counts = {False: Counter(), True: Counter()}

        def table():
            for held, found in counts.items():
                if found:
                    yield pa.record_batch(
                        {
                            "word": pa.array(list(found), pa.binary()),
                            "n": pa.array([0 if held else n for n in found.values()], pa.int64()),
                            "every": pa.array(list(found.values()), pa.int64()),
                        }
                    )
                    found.clear()

        for rows, texts in text_slices(batches):
            flags = rows.column("held").to_pylist()
            for text, held in zip(texts.cast(pa.binary()).to_pylist(), flags):
                found = counts[held]
                found[END] += 1
                for part in pieces(text):
                    found.update(part.translate(LOWER).split())
            if sum(map(len, counts.values())) > COUNTED:
                yield from table()
        yield from table()

    parts = docs.select("text", "held").mapInArrow(run, "word binary, n bigint, every bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("every").alias("every"))


def _level(count: Column) -> Column:
    return F.floor(F.log2(count) * LEVELS).cast("int")


def _ending(word: Column) -> Column:
    return F.when(F.octet_length(word) <= ENDING, word).otherwise(F.substring(word, -ENDING, ENDING))


@dataclass
class Vocabulary:
    """What a worker needs to turn words into units, counts and shares."""

    words: list[bytes]  # frequent words
    counts: np.ndarray  # in learning rows
    units: np.ndarray
    endings: dict[bytes, int]
    tokens: int
    size: int
    unit_counts: np.ndarray  # learning tokens of each unit
    shares: np.ndarray  # log10 of N + V + 1 of units that hold many words, else 0
    level: int  # words from this level on are frequent

    def lookup(self) -> "_Places":
        return _Places(zip(self.words, range(len(self.words))))

    def unit(self, word: bytes) -> int:
        return self.endings.get(word[-ENDING:], OTHER_UNIT)


class _Places(dict):
    def __missing__(self, word):
        return -1


def vocabulary(
    counts: DataFrame, words: int = WORDS, endings: int = ENDINGS, most: int = FREQUENT
) -> Vocabulary:
    """Totals and units; at most ``most`` words and a few hundred rows reach the driver."""
    totals = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    levels = counts.groupBy(_level(F.col("every")).alias("level")).count().collect()
    level, taken = math.inf, 0
    for row in sorted(levels, reverse=True):
        taken += row["count"]
        if taken > most:
            break
        level = row["level"]
    level = min(level, 1 << 20)
    frequent = counts.where(_level(F.col("every")) >= level).select("word", "n").collect()
    frequent = sorted(((bytes(r["word"]), r["n"]) for r in frequent), key=lambda r: (-r[1], r[0]))
    own = [word for word, n in frequent if word != END and n > 0][:words]
    alone = counts.sparkSession.createDataFrame([(bytearray(w),) for w in [END, *own]], "word binary")
    others = counts.join(F.broadcast(alone), "word", "left_anti").where("n > 0")
    others = others.withColumn("ending", _ending(F.col("word")))
    best = others.groupBy("ending").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "ending")
    best = [bytes(row["ending"]) for row in best.limit(endings).collect()]
    first = OTHER_UNIT + 1 + len(own)
    unit_of = {ending: first + i for i, ending in enumerate(best)}
    named = counts.sparkSession.createDataFrame(
        [(bytearray(e), u) for e, u in unit_of.items()], "ending binary, unit int"
    )
    held = others.join(F.broadcast(named), "ending", "left")
    held = held.groupBy(F.coalesce("unit", F.lit(OTHER_UNIT)).alias("unit")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")
    )
    size = first + len(best)
    unit_counts, shares = np.zeros(size, np.int64), np.zeros(size)
    shares[[OTHER_UNIT, *unit_of.values()]] = 0.0
    for row in held.collect():
        unit_counts[row["unit"]] = row["n"]
        shares[row["unit"]] = math.log10(row["n"] + row["v"] + 1)
    places = {word: OTHER_UNIT + 1 + i for i, word in enumerate(own)} | {END: END_UNIT}
    units = [places.get(w, unit_of.get(w[-ENDING:], OTHER_UNIT)) for w, _ in frequent]
    for word, n in frequent:
        if word in places:
            unit_counts[places[word]] = n
    return Vocabulary(
        [word for word, _ in frequent],
        np.array([n for _, n in frequent], np.int64),
        np.array(units, np.int64),
        unit_of,
        int(totals[0] or 0),
        int(totals[1] or 0),
        unit_counts,
        shares,
        level,
    )


# --- units ---------------------------------------------------------------------------

CODED = (
    "row bigint, id {kind}, held boolean, n_tokens bigint, known bigint, logs double, rest double,"
    " units binary, rare array<binary>"
)


def with_units(docs: DataFrame, vocab) -> DataFrame:
    """Each row's units, and of its frequent words the known ones, the sum of log10(c + 1),
    and that sum for the words without a unit of their own; other words in ``rare``."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        key, vocabulary = vocab.value
        lookup = kept(("units", key), vocabulary.lookup)
        logs = np.log10(np.append(vocabulary.counts, 0) + 1.0)
        known = np.append(vocabulary.counts, 0) > 0
        units = np.append(vocabulary.units, OTHER_UNIT)
        rest = np.where((vocabulary.shares > 0)[units], logs, 0.0)
        end = lookup[END]
        for rows, texts in text_slices(batches):
            columns = {name: [] for name in ("n_tokens", "known", "logs", "rest", "units", "rare")}
            for text in texts.cast(pa.binary()).to_pylist():
                places, codes, rare = [], [], []
                for part in pieces(text):
                    words = part.translate(LOWER).split()
                    found = np.fromiter(map(lookup.__getitem__, words), np.int64, len(words))
                    code = units[found].astype(np.uint16)
                    for at in np.flatnonzero(found < 0).tolist():
                        rare.append(words[at])
                        code[at] = vocabulary.unit(words[at])
                    places.append(found)
                    codes.append(code)
                places = np.concatenate([*places, [end]])
                codes = np.concatenate([*codes, [END_UNIT]]).astype(np.uint16)
                columns["n_tokens"].append(len(places))
                columns["known"].append(int(known[places].sum()))
                columns["logs"].append(float(logs[places].sum()))
                columns["rest"].append(float(rest[places].sum()))
                columns["units"].append(codes.tobytes())
                columns["rare"].append(rare)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()))
            made = {n: pa.array(v, t) for (n, v), t in zip(columns.items(), kinds)}
            yield pa.record_batch({n: rows.column(n) for n in ("row", "id", "held")} | made)

    return docs.mapInArrow(run, CODED.format(kind=kind))


def rare_sums(coded: DataFrame, counts: DataFrame, level: int) -> DataFrame:
    """``row``, number of known rare words, and sum of their log10(c + 1)."""
    listed = coded.select("row", F.explode("rare").alias("word"))
    few = counts.where(_level(F.col("every")) < level).select("word", "n")
    return listed.join(few, "word").groupBy("row").agg(
        F.count_if(F.col("n") > 0).alias("rare_known"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_logs")
    )


# --- the network ---------------------------------------------------------------------


class LogBilinear:
    """Vectors of units in the context and as targets, a matrix for each place, biases."""

    def __init__(self, units: int, width: int = WIDTH, context: int = CONTEXT):
        self.units, self.width, self.context = units, width, context
        shapes = [(units, width), (units, width), (context, width, width), (units,)]
        sizes = [int(np.prod(shape)) for shape in shapes]
        cuts = np.cumsum([0, *sizes])
        self.values = np.zeros(cuts[-1], np.float32)
        self.squares = np.full(cuts[-1], 1e-3, np.float32)
        views = [self.values[a:b].reshape(s) for a, b, s in zip(cuts, cuts[1:], shapes)]
        self.inputs, self.targets, self.matrices, self.bias = views
        self.cuts, self.shapes = cuts, shapes

    @classmethod
    def untrained(cls, unit_counts: np.ndarray, width: int = WIDTH, context: int = CONTEXT):
        """Small random vectors; the biases alone give the frequencies."""
        model, rng = cls(len(unit_counts), width, context), np.random.default_rng(42)
        model.inputs[:] = rng.normal(0, 0.3, model.inputs.shape)
        model.targets[:] = rng.normal(0, 0.05, model.targets.shape)
        model.matrices[:] = np.eye(width, dtype=np.float32) / context
        model.bias[:] = np.log(noise_shares(unit_counts))
        return model

    def state(self) -> np.ndarray:
        return np.concatenate([self.values, self.squares])

    def set_state(self, state: np.ndarray) -> "LogBilinear":
        self.values[:], self.squares[:] = np.split(state, 2)
        return self

    def predictions(self, contexts: np.ndarray) -> np.ndarray:
        """Sum over the places of the context of its mapped vectors."""
        mapped = [self.inputs @ matrix for matrix in self.matrices]
        found = mapped[0][contexts[:, 0]]
        for place in range(1, self.context):
            found = found + mapped[place][contexts[:, place]]
        return found

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Of each unit after each context, normalised; the start is never predicted."""
        scores = self.predictions(contexts) @ self.targets.T
        scores += self.bias
        scores[:, START_UNIT] = -np.inf
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return scores

    def following(self, contexts: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Log probability of one unit after each context."""
        found = np.empty(len(units), np.float64)
        mapped = [self.inputs @ matrix for matrix in self.matrices]
        # The bias is one more component, and the start has no weight in the sum.
        targets = np.ascontiguousarray(np.column_stack([self.targets, self.bias]).T)
        targets[-1, START_UNIT] = -np.inf
        predicted = np.ones((BLOCK, self.width + 1), np.float32)
        for at in range(0, len(units), BLOCK):
            part = contexts[at : at + BLOCK]
            rows = predicted[: len(part)]
            rows[:, :-1] = mapped[0][part[:, 0]]
            for place in range(1, self.context):
                rows[:, :-1] += mapped[place][part[:, place]]
            scores = rows @ targets
            chosen = scores[np.arange(len(part)), units[at : at + BLOCK]]
            total = np.exp(scores, out=scores).sum(axis=1)
            if total.max() < 1e30 and total.min() > 1e-30:
                found[at : at + len(part)] = chosen - np.log(total)
            else:
                slow = self.log_probabilities(part)
                found[at : at + len(part)] = slow[np.arange(len(part)), units[at : at + BLOCK]]
        return found

    def learn(
        self, contexts: np.ndarray, units: np.ndarray, noise: np.ndarray, log_noise: np.ndarray
    ) -> None:
        """One step of noise-contrastive estimation, with the drawn ``noise`` shared by all
        contexts; ``log_noise``: log of the number of draws times the chance of each unit."""
        vectors = [self.inputs[contexts[:, i]] for i in range(self.context)]
        predicted = sum(v @ m for v, m in zip(vectors, self.matrices))
        target, drawn = self.targets[units], self.targets[noise]
        true = _sigmoid((predicted * target).sum(axis=1) + self.bias[units] - log_noise[units])
        false = _sigmoid(predicted @ drawn.T + (self.bias[noise] - log_noise[noise]))
        up, down = (1 - true)[:, None], -false
        slope = up * target + down @ drawn
        steps = np.zeros_like(self.values)
        inputs, targets, matrices, bias = (
            steps[a:b].reshape(s) for a, b, s in zip(self.cuts, self.cuts[1:], self.shapes)
        )
        targets += _added(units, up * predicted, self.units)
        np.add.at(targets, noise, down.T @ predicted)
        bias += np.bincount(units, up[:, 0], self.units)
        np.add.at(bias, noise, down.sum(axis=0))
        for place, vector in enumerate(vectors):
            matrices[place] = vector.T @ slope
            inputs += _added(contexts[:, place], slope @ self.matrices[place].T, self.units)
        steps /= len(units)
        self.squares += steps * steps
        self.values += RATE * steps / np.sqrt(self.squares)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _added(at: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sums of rows by their place."""
    width = rows.shape[1]
    cells = at[:, None] * width + np.arange(width)
    return np.bincount(cells.ravel(), rows.ravel(), count * width).reshape(count, width)


def noise_shares(unit_counts: np.ndarray) -> np.ndarray:
    """Chance of each unit to be drawn: its smoothed frequency."""
    return (unit_counts + 1.0) / (unit_counts + 1.0).sum()


def with_contexts(units: np.ndarray, lengths: np.ndarray, context: int) -> np.ndarray:
    """The ``context`` units before each, nearest first; before the text: the start."""
    ends = np.cumsum(lengths)
    place = np.arange(len(units)) - np.repeat(ends - lengths, lengths)
    made = np.zeros((len(units), context), np.int64)
    for back in range(1, context + 1):
        inside = np.flatnonzero(place >= back)
        made[inside, back - 1] = units[inside - back]
    return made


def _texts(batches, column: str = "units", most: int = 1 << 19):
    """Rows of batches with their units, at most about ``most`` tokens at a time."""
    for batch in batches:
        coded = batch.column(column).to_pylist()
        lengths = np.array([len(x) // 2 for x in coded], np.int64)
        start, ends = 0, np.cumsum(lengths)
        while start < len(coded):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            units = np.frombuffer(b"".join(coded[start:stop]), np.uint16).astype(np.int64)
            yield batch.slice(start, stop - start), units, lengths[start:stop]
            start = stop


def train(coded: DataFrame, unit_counts: np.ndarray, rounds: int = ROUNDS) -> LogBilinear:
    """One pass over all rows that are not held out, in ``rounds`` of averaged parameters."""
    spark = coded.sparkSession
    shares = noise_shares(unit_counts)
    # The start is in contexts only.
    shares[START_UNIT] = 0.0
    shares /= shares.sum()
    model = LogBilinear.untrained(unit_counts)
    learning = coded.where(~F.col("held"))
    for number in range(rounds):
        state = spark.sparkContext.broadcast(model.state())

        def run(batches):
            own = LogBilinear(len(shares)).set_state(state.value)
            log_noise = np.log(NOISE * np.maximum(shares, 1e-300)).astype(np.float32)
            tokens, rng = 0, None
            for rows, units, lengths in _texts(batches):
                contexts = with_contexts(units, lengths, own.context)
                if rng is None:
                    rng = np.random.default_rng([number, rows.column("row")[0].as_py()])
                order = rng.permutation(len(units))
                steps = -(-len(order) // BATCH)
                drawn = rng.choice(len(shares), (steps, NOISE), p=shares)
                for step in range(steps):
                    part = order[step * BATCH : (step + 1) * BATCH]
                    own.learn(contexts[part], units[part], drawn[step], log_noise)
                tokens += len(units)
            if tokens:
                yield _weighted(own.state().astype(np.float64) * tokens, tokens)

        part = learning.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == number)
        made = part.select("row", "units").mapInArrow(run, "sums array<double>, tokens bigint")
        # A few streams add up the states of all tasks, one at a time.
        spread = made.repartition(STREAMS, F.spark_partition_id())
        total, tokens = 0.0, 0
        for row in spread.mapInArrow(_summed, made.schema).collect():
            total, tokens = total + np.array(row["sums"]), tokens + row["tokens"]
        if tokens:
            model.set_state((total / tokens).astype(np.float32))
        state.unpersist()
    return model


def _weighted(sums: np.ndarray, tokens: int) -> pa.RecordBatch:
    return pa.record_batch({"sums": pa.array([sums], pa.list_(pa.float64())), "tokens": pa.array([tokens], pa.int64())})


def _summed(batches):
    total, tokens = 0.0, 0
    for batch in batches:
        for row in range(batch.num_rows):
            total = total + batch.column("sums")[row].values.to_numpy()
            tokens += batch.column("tokens")[row].as_py()
    if tokens:
        yield _weighted(total, tokens)


def text_scores(coded: DataFrame, model: LogBilinear, shares: np.ndarray) -> DataFrame:
    """``coded`` without units, with ``unit_score``: log10 of the model's probability of the
    units of each row and, for words without one of their own, less that of their unit's size."""
    kept_columns = [f for f in coded.schema.fields if f.name not in ("units", "rare")]
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept_columns)
    sent = coded.sparkSession.sparkContext.broadcast((model.state(), model.units, shares))

    def run(batches):
        state, size, logs = sent.value
        own = LogBilinear(size).set_state(state)
        for rows, units, lengths in _texts(batches):
            contexts = with_contexts(units, lengths, own.context)
            found = own.following(contexts, units) / math.log(10) - logs[units]
            ends = np.cumsum(lengths)
            scores = np.add.reduceat(found, ends - lengths) if len(lengths) else found
            yield pa.record_batch(
                {f.name: rows.column(f.name) for f in kept_columns} | {"unit_score": pa.array(scores)}
            )

    return coded.drop("rare").mapInArrow(run, f"{layout}, unit_score double")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    (add-one word frequencies) and ``score`` (the model) of each row, learned from the rows
    that are not held out."""
    spark = docs.sparkSession
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        held_out(F.col(id_col)).alias("held"),
        F.col(text_col).alias("text"),
    )
    counts = materialize(word_counts(slim), "word-counts")
    vocab = vocabulary(counts)
    sent = spark.sparkContext.broadcast((scratch_path(spark, "vocabulary"), vocab))
    coded = materialize(with_units(slim, sent), "units")
    model = train(coded, vocab.unit_counts)
    scored = text_scores(coded, model, vocab.shares)
    found = scored.join(rare_sums(coded, counts, vocab.level), "row", "left").na.fill(
        {"rare_known": 0, "rare_logs": 0.0}
    )
    base = F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * math.log10(vocab.tokens + vocab.size + 1)
    return found.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.col("rare_known")).alias("n_known"),
        F.lit(vocab.tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("unit_score") + F.col("rest") + F.col("rare_logs")).alias("score"),
    )
