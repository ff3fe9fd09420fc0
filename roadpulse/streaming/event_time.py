"""Event time and lateness of streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

MAX_DELAY = "60 seconds"
LATE, ON_TIME = "late", "on-time"


def with_fcd_watermark(events: DataFrame, delay: str = MAX_DELAY) -> DataFrame:
    """Events may be ``delay`` out of order; later ones are dropped by the windows.

    Windows of a stream come out once, when the watermark has passed their end. Every
    event advances the watermark, whatever is selected later: see ``barrier``. On a batch
    this changes nothing.
    """
    if dict(events.dtypes)["timestamp"] != "timestamp":
        events = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    events = events.withWatermark("timestamp", delay)
    return barrier(events) if events.isStreaming else events


def barrier(events: DataFrame) -> DataFrame:
    """The same rows, with columns that no predicate above can be pushed through.

    Spark moves a filter that does not use the event time below the watermark, and then
    rows that the filter drops, such as those outside the box, do not advance event time:
    a fleet that leaves the box would hold all windows open. Columns made by a generator
    stop that; the event time itself passes by, with its watermark.
    """
    others = [name for name in events.columns if name != "timestamp"]
    row = F.array(F.struct(*others))
    return events.select("timestamp", F.inline(row)).select(*events.columns)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the windows of a query have dropped as late, as far as its progress
    reports go back."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def window_end(timestamp: Column, minutes: int) -> Column:
    """End of the tumbling window of a time."""
    width = minutes * 60_000_000
    return F.timestamp_micros((F.floor(F.unix_micros(timestamp) / width) + 1) * width)


def split_late(
    events: DataFrame,
    path: str,
    checkpoint: str,
    minutes: int,
    delay_seconds: int = 60,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store a stream's events as on-time and late ones in folders of ``path``.

    An event is late when its window was closed before its micro-batch began: the window's end
    is not after the latest event of all earlier batches, less the delay. That event is kept in
    a ledger beside ``path``, with an entry for each batch that is written after the batch's
    rows. So a replayed batch is judged as before and replaces its rows, and ``stored_events``
    reads whole batches only. No event is dropped: the two folders together hold the input.
    """

    def store(batch: DataFrame, number: int) -> None:
        store_by_lateness(batch, number, path, minutes, delay_seconds)

    writer = events.writeStream.foreachBatch(store).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def store_by_lateness(
    batch: DataFrame, number: int, path: str, minutes: int, delay_seconds: int = 60
) -> None:
    """One micro-batch of ``split_late``; a repeated number replaces its rows."""
    spark = batch.sparkSession
    ledger = f"{path.rstrip('/')}-ledger"
    latest = None
    if number > 0:
        entries = spark.read.schema("batch bigint, latest timestamp").parquet(f"{ledger}/*")
        latest = entries.where(F.col("batch") < number).agg(F.max("latest")).first()[0]
    late = F.lit(False)
    if latest is not None:
        mark = F.lit(latest) - F.expr(f"INTERVAL {delay_seconds} SECONDS")
        late = window_end(F.col("timestamp"), minutes) <= mark
    kind = F.when(late, LATE).otherwise(ON_TIME)
    rows = batch.select("*", kind.alias("kind"), F.lit(number).alias("batch"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("kind", "batch").parquet(path)
    # Of the rows just written, the times alone.
    written = spark.read.schema(rows.schema).parquet(path).where(F.col("batch") == number)
    entry = written.agg(F.max("timestamp").alias("latest")).select(
        F.lit(number).cast("bigint").alias("batch"), "latest"
    )
    entry.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/entry={number}")


def stored_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Events that ``split_late`` has stored, with ``kind`` (late or on-time)."""
    entered = spark.read.schema("batch bigint").parquet(f"{path.rstrip('/')}-ledger/*")
    layout = T.StructType([*schema.fields, T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType())])
    rows = spark.read.schema(layout).parquet(path)
    return rows.join(F.broadcast(entered.distinct()), "batch", "left_semi").drop("batch")
