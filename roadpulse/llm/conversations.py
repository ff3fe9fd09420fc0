"""Operator 13: least repair of conversations by a rank-convergence parallel Viterbi.

A conversation is repaired when its roles are an optional system turn and then pairs of a
user's and an assistant's turn. Rows are kept, given another role, or deleted, and turns
without text are inserted, at least cost. Four states tell what a prefix has led to:
nothing yet, a system turn, a user's turn, an assistant's turn. Going backward over the
rows gives for each state the cost of the rest.

Rows with equal turn, role and text are one kind with a count; blank rows and copies have
to be deleted and leave cost vectors as they are, so no group of copies is ever listed. The
kinds are sorted by ranges of conversation and turn and cut into chunks of at most
``CHUNK``. All chunks go backward at once, each from a speculative vector at its end. Then
fix-up passes give each chunk the vector at the start of the next one: it runs again from
its end until its vector differs from that of before only by a constant, from where the
rest stays as it is. Passes end when no chunk's start has changed by more than a constant;
the constants are summed apart. In usual conversations two turns are enough to forget the
speculation, so there is one pass; a long run of one role can need one for each chunk.

The stitched costs drive the trace forward: at each place the first of D, I, K, R that
keeps to the least cost, which gives the least audit. Each chunk is traced from all four
states; composing these steps gives the state each chunk is really entered with.

Only the rows that stay take their texts along again, in chunks. The digest of a
conversation of several chunks reads them in order as a stream, one chunk at a time.

Nulls: a null role or text is one space, as is a null id or turn in the key of the damage;
null turns come first; rows with a null id are one conversation. Rows of one turn are
ordered by role and then by the SHA-256 of their text. Very long texts are never cut. Roles
are told by their first letter; a role of no known letter can only be changed or deleted.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import materialize

CHUNK = 1024  # kinds of rows; a power of two
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
SPACES = " \t\n\x0b\x0c\r"
# States, which are also the codes of roles: none, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = (USER, USER, ASSISTANT, USER)  # the role that can be put after each state
DELETE, CHANGE, INSERT = 3, 2, 2
ENDS = (0, 4, 2, 0)  # cost of completing each state
GUESS = (0, 0, 0, 0)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
ROLE, FAULT = 3, 2  # bits of a code: role, and fault above it

Vector = tuple[int, int, int, int]


# --- one chunk -----------------------------------------------------------------------


def kept_state(state: int, role: int) -> int | None:
    """State after keeping a row of this role, if it may be kept."""
    if role == FOLLOWS[state]:
        return role
    return SYSTEM if state == START and role == SYSTEM else None


def before(code: int, after: Vector) -> Vector:
    """Costs of the rest before a row that need not be deleted, from those after it."""
    role, more = code & ROLE, int(code >> FAULT == TRUNCATED)
    costs = []
    for state in range(4):
        cost = min(DELETE + after[state], CHANGE + more + after[FOLLOWS[state]])
        stays = kept_state(state, role)
        costs.append(cost if stays is None else min(cost, more + after[stays]))
    none, system, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(none, INSERT + user), min(system, INSERT + user), user, assistant


def deleted(code: int) -> bool:
    return code >> FAULT in (BLANK, DUPLICATE)


def backward(codes: bytes, end: Vector, known: bytes | None = None, steps: bytes | None = None):
    """Cost vectors before each row and at the end, less their least, as bytes, and that
    least for each row. With ``known`` vectors and steps of another end, only the rows up to
    where the vectors differ by a constant are new."""
    vector = end
    vectors, mins = bytearray(known or bytes(4 * len(codes) + 4)), bytearray(steps or bytes(len(codes)))
    vectors[4 * len(codes) :] = bytes(vector)
    for at in range(len(codes) - 1, -1, -1):
        if not deleted(codes[at]):
            vector = before(codes[at], vector)
            mins[at] = min(vector)
            vector = tuple(cost - mins[at] for cost in vector)
        if known is not None and known[4 * at : 4 * at + 4] == bytes(vector):
            break
        vectors[4 * at : 4 * at + 4] = bytes(vector)
    return bytes(vectors), bytes(mins)


def trace(codes: bytes, counts: list[int], vectors: bytes, state: int, last: bool):
    """(state at the end, audit, what stays: (place or None, role or None for its own))."""
    audit, stays = [], []
    for at, code in enumerate(codes):
        if deleted(code):
            audit.append("D" * counts[at])
            continue
        after = tuple(vectors[4 * at + 4 : 4 * at + 8])
        now, more = before(code, after), int(code >> FAULT == TRUNCATED)
        while True:
            if DELETE + after[state] == now[state]:
                audit.append("D")
                break
            put = FOLLOWS[state]
            if INSERT + now[put] == now[state]:
                audit.append("I")
                stays.append((None, NAMES[put]))
                state = put
                continue
            own = kept_state(state, code & ROLE)
            if own is not None and more + after[own] == now[state]:
                audit.append("K")
                stays.append((at, None))
                state = own
            else:
                audit.append("R")
                stays.append((at, NAMES[put]))
                state = put
            break
        audit.append("D" * (counts[at] - 1))
    while last and state in (SYSTEM, USER):
        state = FOLLOWS[state]
        audit.append("I")
        stays.append((None, NAMES[state]))
    return state, "".join(audit), stays


# --- rows ----------------------------------------------------------------------------


def damaged(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv`` (text, empty for a null id), ``turn``, ``role``, ``text`` and ``copies`` of
    the rows that the damage leaves."""
    number, turn = F.col(id_col), F.col(turn_col).cast("bigint")
    parts = (F.coalesce(part.cast("string"), F.lit(" ")) for part in (number, turn))
    kind = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in (role_col, text_col))
    return rows.select(
        F.coalesce(F.concat(F.lit("="), number.cast("string")), F.lit("")).alias("conv"),
        turn.alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"),
        kind.alias("kind"),
    ).where("kind <> 0").drop("kind")


def with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def kinds_of_rows(rows: DataFrame) -> DataFrame:
    """Different rows in order (``pos``), with their ``count`` and ``code``."""
    body = F.rtrim("text", F.lit(SPACES))
    spoiled = F.when(body == "", BLANK).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
    slim = with_digest(rows).select(
        "conv",
        F.col("turn").isNotNull().alias("timed"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        "role",
        "digest",
        F.coalesce(spoiled, F.lit(0)).alias("fault"),
        "copies",
    )
    order = ["conv", "timed", "turn", "role", "digest"]
    kinds = slim.groupBy(*order).agg(F.max("fault").alias("fault"), F.sum("copies").alias("count"))
    firsts = slim.groupBy("conv", "role", "digest").agg(F.min(F.struct("timed", "turn")).alias("at"))
    firsts = firsts.select("conv", "at.*", "role", "digest", F.lit(True).alias("first"))
    kinds = kinds.join(firsts, order, "left")
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("first"), F.col("fault")).otherwise(DUPLICATE)
    role = F.lit(0)
    for letter, code in INITIALS.items():
        role = F.when(F.substring("role", 1, 1) == letter, code).otherwise(role)
    code = (role + F.shiftleft(fault, FAULT)).cast("int").alias("code")
    spread = kinds.select(*order, code, "count").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(spread.withColumn("pos", F.monotonically_increasing_id()), "kinds")


# --- chunks --------------------------------------------------------------------------

CHUNKS = (
    "conv string, block bigint, places array<bigint>, codes binary, counts array<bigint>,"
    " vectors binary, steps binary, start binary, moved boolean"
)


def chunks_of(kinds: DataFrame, chunk: int) -> DataFrame:
    """Chunks with vectors from the guess; ``start`` is null if every row is deleted."""
    row = F.struct("pos", "code", "count")
    block = F.floor(F.col("pos") / chunk).alias("block")
    grouped = kinds.groupBy("conv", block).agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def run(batches):
        for batch in batches:
            made = []
            for conv, block, rows in _records(batch, "conv", "block", "rows"):
                codes = bytes(row["code"] for row in rows)
                vectors, steps = backward(codes, GUESS)
                made.append(
                    (conv, block, [r["pos"] for r in rows], codes, [r["count"] for r in rows])
                    + (vectors, steps, _start(codes, vectors), True)
                )
            yield _table(made, CHUNKS)

    return grouped.mapInArrow(run, CHUNKS)


def _start(codes: bytes, vectors: bytes) -> bytes | None:
    return None if all(map(deleted, codes)) else vectors[:4]


def fixed(state: DataFrame) -> DataFrame:
    """One fix-up pass. ``moved``: the start is another one, by more than a constant."""
    later = Window.partitionBy("conv").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    asked = state.withColumn("wanted", F.last("start", ignorenulls=True).over(later))

    def run(batches):
        names = [part.split()[0] for part in CHUNKS.split(", ")]
        for batch in batches:
            made = []
            for *values, wanted in _records(batch, *names, "wanted"):
                row = dict(zip(names, values))
                end = bytes(ENDS) if wanted is None else wanted
                first, row["moved"] = row["start"], False
                if row["vectors"][-4:] != end:
                    known = row["vectors"], row["steps"]
                    row["vectors"], row["steps"] = backward(row["codes"], tuple(end), *known)
                    row["start"] = _start(row["codes"], row["vectors"])
                    row["moved"] = row["start"] != first
                made.append(tuple(row.values()))
            yield _table(made, CHUNKS)

    return asked.mapInArrow(run, CHUNKS)


def stitched(kinds: DataFrame, chunk: int) -> DataFrame:
    state = materialize(chunks_of(kinds, chunk), "speculated")
    while True:
        state = materialize(fixed(state), "fixed")
        if state.where("moved").limit(1).count() == 0:
            return state


def with_entries(state: DataFrame) -> DataFrame:
    """Chunks with the state they are entered with (``entry``), whether they are the last of
    their conversation, and the codes of the chunk before."""
    along = Window.partitionBy("conv").orderBy("block")
    placed = state.withColumns(
        {
            "last": F.lead("block").over(along).isNull(),
            "earlier": F.lag("codes").over(along),
        }
    )
    steps = placed.where(~F.col("last") | F.col("earlier").isNotNull())

    def run(batches):
        for batch in batches:
            made = []
            for conv, block, codes, counts, vectors, last in _records(
                batch, "conv", "block", "codes", "counts", "vectors", "last"
            ):
                leaves = [trace(codes, counts, vectors, state, last)[0] for state in range(4)]
                made.append((conv, block, bytes(leaves)))
            yield _table(made, "conv string, block bigint, leaves binary")

    maps = steps.mapInArrow(run, "conv string, block bigint, leaves binary")
    chains = maps.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "leaves"))).alias("chain"))

    def enter(batches):
        for batch in batches:
            made = []
            for conv, chain in _records(batch, "conv", "chain"):
                state = START
                for link in chain:
                    made.append((conv, link["block"], state))
                    state = link["leaves"][state]
            yield _table(made, "conv string, block bigint, entry int")

    entries = chains.mapInArrow(enter, "conv string, block bigint, entry int")
    return placed.join(entries, ["conv", "block"], "left").na.fill({"entry": START})


TRACED = (
    "conv string, block bigint, audit string, stays array<struct<n:int,pos:bigint,role:string>>,"
    " start binary, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)


def traced(entered: DataFrame) -> DataFrame:
    def run(batches):
        names = ("conv", "block", "places", "codes", "counts", "vectors", "steps", "start")
        for batch in batches:
            made = []
            for conv, block, places, codes, counts, vectors, steps, start, last, earlier, entry in _records(
                batch, *names, "last", "earlier", "entry"
            ):
                _, audit, stays = trace(codes, counts, vectors, entry, last)
                listed = [
                    {"n": n, "pos": None if at is None else places[at], "role": role}
                    for n, (at, role) in enumerate(stays)
                ]
                faults = [code >> FAULT for code in codes]
                blank = sum(c for c, f in zip(counts, faults) if f == BLANK)
                copies = sum(c if f == DUPLICATE else c - 1 for c, f in zip(counts, faults) if f != BLANK)
                roles = [code & ROLE for code in (earlier[-1:] if earlier else b"") + codes]
                illegal = sum(pair not in LEGAL for pair in zip(roles, roles[1:])) + sum(counts) - len(counts)
                cost = sum(steps) + DELETE * (blank + copies)
                cut = faults.count(TRUNCATED)
                made.append((conv, block, audit, listed, start, cost, blank, copies, cut, illegal))
            yield _table(made, TRACED)

    return entered.mapInArrow(run, TRACED)


def _records(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(name).to_pylist() for name in names))


ARROW = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<struct<n:int,pos:bigint,role:string>>": pa.list_(
        pa.struct([("n", pa.int32()), ("pos", pa.int64()), ("role", pa.string())])
    ),
}


def _table(rows: list[tuple], layout: str) -> pa.RecordBatch:
    fields = [part.split() for part in layout.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.record_batch({name: pa.array(c, ARROW[kind]) for (name, kind), c in zip(fields, columns)})


# --- texts ---------------------------------------------------------------------------


def repaired_segments(rows: DataFrame, kinds: DataFrame, chunks: DataFrame) -> DataFrame:
    """``conv``, ``block`` and ``segment``: the repaired lines of each chunk that has some."""
    listed = chunks.select("conv", "block", F.inline("stays"))
    put = listed.where("pos IS NULL").select("conv", "block", "n", F.concat("role", F.lit(":")).alias("line"))
    own = kinds.select("pos", F.col("role").alias("own"), "digest")
    stays = listed.where("pos IS NOT NULL").join(own, "pos")
    texts = with_digest(rows).groupBy("conv", F.col("role").alias("own"), "digest").agg(F.min("text").alias("text"))
    line = F.concat(F.coalesce("role", "own"), F.lit(":"), "text").alias("line")
    lines = stays.join(texts, ["conv", "own", "digest"]).select("conv", "block", "n", line).union(put)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"])
    return lines.groupBy("conv", "block").agg(F.array_join(ordered, "\n").alias("segment"))


def digests(segments: DataFrame) -> DataFrame:
    """SHA-256 of the segments of each conversation, joined by line ends."""
    counts = segments.groupBy("conv").agg(F.count(F.lit(1)).alias("parts"))
    sized = segments.join(counts, "conv")
    single = sized.where("parts = 1").select("conv", F.sha2(F.col("segment").cast("binary"), 256).alias("sha"))
    several = sized.where("parts > 1").select("conv", "block", "segment")
    in_order = several.repartition(F.col("conv")).sortWithinPartitions("conv", "block")

    def run(batches):
        conv, state = None, None
        for batch in batches:
            done = []
            for at in range(batch.num_rows):
                name, text = batch.column("conv")[at].as_py(), batch.column("segment")[at].as_py().encode()
                if name != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = name, hashlib.sha256(text)
                else:
                    state.update(b"\n" + text)
            yield _table(done, "conv string, sha string")
        if state is not None:
            yield _table([(conv, state.hexdigest())], "conv string, sha string")

    return single.union(in_order.mapInArrow(run, "conv string, sha string"))


def turn_gaps(kinds: DataFrame) -> DataFrame:
    """``gaps`` between the least and greatest turn of each conversation."""
    turns = kinds.where("timed").select("conv", "turn").distinct()
    wide = turns.groupBy("conv").agg(F.max("turn").alias("b"), F.min("turn").alias("a"), F.count(F.lit(1)).alias("n"))
    exact = F.col("b").cast("decimal(20,0)") - F.col("a").cast("decimal(20,0)") + 1 - F.col("n")
    return wide.select("conv", F.least(exact, F.lit((1 << 63) - 1)).cast("bigint").alias("gaps"))


NOTHING = hashlib.sha256(b"").hexdigest()


def repair(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """One row for each id of ``conversations``: ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``."""
    rows = damaged(conversations, id_col, turn_col, role_col, text_col)
    kinds = kinds_of_rows(rows)
    chunks = materialize(traced(with_entries(stitched(kinds, chunk))), "traced")
    sums = [F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal")]
    audits = F.array_sort(F.collect_list(F.struct("block", "audit")))
    begin = F.min(F.when(F.col("start").isNotNull(), F.struct("block", "start")))["start"]
    first = F.coalesce(F.conv(F.hex(F.substring(begin, 1, 1)), 16, 10).cast("bigint"), F.lit(0))
    reports = chunks.groupBy("conv").agg(
        *sums,
        (F.sum("cost") + first).alias("cost"),
        F.array_join(F.transform(audits, lambda x: x["audit"]), "").alias("audit"),
    )
    segments = materialize(repaired_segments(rows, kinds, chunks), "repaired")
    ids = conversations.select(F.col(id_col).alias("id")).distinct()
    ids = ids.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")))
    found = ids.join(reports, "conv", "left").join(turn_gaps(kinds), "conv", "left")
    found = found.join(digests(segments), "conv", "left")
    found = found.na.fill({"audit": "", "sha": NOTHING})
    longs = [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("gaps", "blank", "duplicate")]
    longs += [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("truncated", "illegal", "cost")]
    return found.select(F.col("id").alias(id_col), *longs, "audit", F.col("sha").alias("repaired_sha256"))
