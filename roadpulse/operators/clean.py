"""Cleaning and record projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions import grid as grid_fn
from roadpulse.functions.rows import keep_if
from roadpulse.functions.text import print_event_time
from roadpulse.schema import BOX, DEFAULTS, EVENT_COLUMNS, Box

# The archive layout carries two values live records do not have (fixed values).
ARCHIVE_VALID = 1
ARCHIVE_ZONE = 20

GOOD, REJECTED = "good", "rejected"


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and rejected lines with the reason, from a parsed source.

    Both are lazy and nothing is cached, so using both reads and parses the source twice;
    ``store_split`` does it in one pass.
    """
    fields = [name for name in parsed.columns if name not in ("line", "reject")]
    good = keep_if(parsed, F.col("reject").isNull(), fields)
    bad = keep_if(parsed, F.col("reject").isNotNull(), ["line", "reject"])
    return good, bad


def store_split(
    parsed: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None
) -> tuple[DataFrame, DataFrame] | StreamingQuery:
    """Read and parse once; store good and rejected records in folders of ``path``.

    A batch gives (good records, rejected lines with the reason) from what was stored, and
    a repeated run replaces it. A stream gives the running query; its good records are a
    Parquet source for ``stored_good``.
    """
    outcome = F.when(F.col("reject").isNull(), GOOD).otherwise(REJECTED)
    rows = parsed.withColumn("outcome", outcome)
    if parsed.isStreaming:
        if checkpoint is None:
            raise ValueError("a stream needs a checkpoint folder")
        writer = rows.writeStream.format("parquet").partitionBy("outcome").outputMode("append")
        writer = writer.option("path", path).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()
    rows.write.mode("overwrite").partitionBy("outcome").parquet(path)
    stored = parsed.sparkSession.read.schema(rows.schema).parquet(path)
    fields = [name for name in parsed.columns if name not in ("line", "reject")]
    good = stored.where(F.col("outcome") == GOOD).select(*fields)
    bad = stored.where(F.col("outcome") == REJECTED).select("line", "reject")
    return good, bad


def stored_good(path: str) -> str:
    """The folder of the good records that ``store_split`` has put under ``path``."""
    return f"{path.rstrip('/')}/outcome={GOOD}"


REASONS = ("field count", *EVENT_COLUMNS, "array")


def observe_quality(
    parsed: DataFrame, observation: Observation | str, reasons: bool = False
) -> DataFrame:
    """Count good and rejected records as a side effect of the pass that reads them; with
    ``reasons`` also the rejected ones by reason."""
    counts = [
        F.count_if(F.col("reject").isNull()).alias("good"),
        F.count_if(F.col("reject").isNotNull()).alias("rejected"),
    ]
    if reasons:
        counts += [F.count_if(F.col("reject") == reason).alias(reason) for reason in REASONS]
    return parsed.observe(observation, *counts)


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Records per outcome; ``reject`` is NULL for the good ones."""
    return parsed.groupBy("reject").agg(F.count(F.lit(1)).alias("records"))


def fill_defaults(events: DataFrame) -> DataFrame:
    """Missing measures become 0."""
    return events.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in DEFAULTS.items()}
    )


def drop_unidentified(records: DataFrame, id_column: str = "device_random_id") -> DataFrame:
    """Records of vehicles that sent an empty (or no) id are dropped."""
    identified = F.length(F.trim(F.col(id_column).cast("string"))) > 0
    return keep_if(records, identified, records.columns)


def in_bbox(events: DataFrame, box: Box = BOX) -> DataFrame:
    """Flag points strictly inside the box."""
    flag = grid_fn.inside(F.col("lon"), F.col("lat"), box)
    return events.withColumn("in_bbox", F.coalesce(flag, F.lit(False)))


def filter_bbox(events: DataFrame, box: Box = BOX) -> DataFrame:
    return events.where(grid_fn.inside(F.col("lon"), F.col("lat"), box))


def dedup_events(events: DataFrame, keep: str = "smallest") -> DataFrame:
    """One event per device and millisecond: the smallest copy, by its other columns in
    their order.

    Copies are merged before the shuffle, so a heavily repeated event costs one row per input
    split. A stream, which needs a watermark, follows the same rule: a millisecond is a window of
    its own, whose state is the smallest copy so far, given out when the watermark has passed.
    ``keep="first"`` gives a stream's first copy at once instead, and forgets it when the
    watermark has passed; which one that is depends on how the rows arrive.
    """
    if keep not in ("smallest", "first"):
        raise ValueError(f"keep must be smallest or first, got {keep!r}")
    others = F.struct(*(F.col(name) for name in events.columns if name != "device_id"))
    if not events.isStreaming:
        keyed = events.withColumn("_millis", F.unix_millis("timestamp"))
        grouped = keyed.groupBy("device_id", "_millis")
    elif keep == "first":
        keyed = events.withColumn("_millis", F.unix_millis("timestamp"))
        return keyed.dropDuplicatesWithinWatermark(["device_id", "_millis"]).drop("_millis")
    else:
        grouped = events.groupBy("device_id", F.window("timestamp", "1 millisecond"))
    smallest = grouped.agg(F.min(others).alias("_smallest"))
    return smallest.select("device_id", "_smallest.*").select(*events.columns)


def to_gps_columns(events: DataFrame) -> DataFrame:
    """Live events in the 12-column archive layout; speed loses its fraction, and is NULL
    where it is no number or no whole number of that layout's range."""
    recorded = print_event_time(F.col("timestamp"))
    return events.select(
        "device_id",
        recorded.alias("inserted_timestamp"),
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
        "altitude",
        F.col("speed").try_cast("int").alias("speed"),
        "orientation",
        recorded.alias("recorded_timestamp"),
        F.lit(ARCHIVE_VALID).alias("valid"),
        F.lit(ARCHIVE_ZONE).alias("zoneid"),
        "transfer",
        recorded.alias("unix_timestamp"),
    )


def tsv_line() -> Column:
    """One event as tab-separated text, timestamp with milliseconds."""
    fields = {name: F.col(name).cast("string") for name in EVENT_COLUMNS}
    fields["timestamp"] = print_event_time(F.col("timestamp"))
    return F.concat_ws("\t", *(F.coalesce(field, F.lit("")) for field in fields.values()))


def to_tsv_line(events: DataFrame) -> DataFrame:
    """Text export: one column ``value``."""
    return events.select(tsv_line().alias("value"))
