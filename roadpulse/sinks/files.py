"""File and console writers.

A streaming DataFrame goes to Spark's own file sink: its commit log makes each row
appear once, also after a restart from the checkpoint.

Windows can have a folder each, as minutes, or share one with the other windows of their
hour or day. A folder costs a rename when a batch replaces it, one after another on the
driver, so with many short windows days are the better choice: their rows are sorted by
window, and a window is found by the statistics of the files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.session import materialize

MAX_RECORDS_PER_FILE = 5_000_000
# Letters of ``yyyy-MM-dd--HHmm`` that name a folder.
LEVELS = {"minute": 16, "hour": 14, "day": 10}


def minute_bucket(timestamp: Column) -> Column:
    """Folder name ``yyyy-MM-dd--HHmm`` of a window label."""
    return F.concat(
        F.substring(timestamp, 1, 10),
        F.lit("--"),
        F.substring(timestamp, 12, 2),
        F.substring(timestamp, 15, 2),
    )


def row_text(rows: DataFrame) -> Column:
    """A row as ``(a,b,c)``."""
    values = F.concat_ws(",", *(F.col(name).cast("string") for name in rows.columns))
    return F.concat(F.lit("("), values, F.lit(")"))


def window_folder(bucket: Column, level: str) -> Column:
    """The folder of a window: its minute, its hour (``yyyy-MM-dd--HH``) or its day."""
    if level not in LEVELS:
        raise ValueError(f"level must be one of {', '.join(LEVELS)}, got {level!r}")
    return F.substring(bucket, 1, LEVELS[level])


def write_bucketed(
    results: DataFrame,
    path: str,
    checkpoint: str | None = None,
    file_format: str = "text",
    trigger: dict | None = None,
    level: str = "minute",
) -> StreamingQuery | None:
    """Results in one folder per window end (``bucket=``), or per hour or day of it.

    The folder comes from the data. A batch replaces the windows it writes and no other, so
    a repeated run leaves the same; a stream adds to them. Rows are dealt out by folder
    first: small folders get one file, and a batch divides large ones. In an hour or day
    rows are sorted by window; except in text, they have it as a column ``bucket``.
    """
    place = results.columns.index("timestamp")
    rows = results.withColumn("bucket", minute_bucket(F.col("timestamp")))
    written = minute_bucket(F.col("timestamp"))
    if file_format == "text":
        rows = rows.select(row_text(results).alias("value"), "bucket")
        line = F.expr("substring(value, 2, length(value) - 2)")
        written = minute_bucket(F.split(line, ",")[place])
    return write_windows(rows, path, checkpoint, file_format, trigger, level, written)


def write_windows(
    rows: DataFrame,
    path: str,
    checkpoint: str | None,
    file_format: str,
    trigger: dict | None,
    level: str,
    written: Column,
) -> StreamingQuery | None:
    """``rows`` with their ``bucket`` into the folders of ``level``. ``written``: the bucket
    of a row that is read from there again."""
    if level == "minute":
        return _write(rows, path, "bucket", checkpoint, file_format, trigger)
    rows = rows.withColumn(level, window_folder(F.col("bucket"), level))
    if not rows.isStreaming:
        rows = _with_others(rows, path, file_format, level, "bucket", written)
    if file_format == "text" or not rows.isStreaming:
        kept = [name for name in rows.columns if name != "bucket" or file_format == "parquet"]
    else:
        kept = rows.columns
    if rows.isStreaming:
        return _write(rows.select(*kept), path, level, checkpoint, file_format, trigger)
    rows = rows.hint("rebalance", level).sortWithinPartitions(level, "bucket")
    writer = rows.select(*kept).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _capped(writer.partitionBy(level).format(file_format)).save(path)
    return None


def _with_others(
    rows: DataFrame, path: str, file_format: str, folder: str, key: str, written: Column | None = None
) -> DataFrame:
    """``rows`` and those already in their folders whose ``key`` is not written now. The new
    ones are stored first, as they are read more than once. ``written``: the key of a stored
    row, if it is not a column of its own."""
    spark = rows.sparkSession
    schema = rows.schema if written is None else rows.drop(key).schema
    try:
        there = spark.read.schema(schema).format(file_format).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows
    rows = materialize(rows, "written-now")
    folders = [row[0] for row in rows.select(folder).distinct().collect()]
    there = there.where(F.col(folder).isin(folders))
    if written is not None:
        there = there.withColumn(key, written)
    there = there.join(rows.select(key).distinct(), key, "left_anti").select(*rows.columns)
    return rows.unionByName(materialize(there, "written-before"))


def write_overwrite(results: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace what is at ``path`` (batch)."""
    _capped(results.write.mode("overwrite").format(file_format)).save(path)


def write_by_segment(
    results: DataFrame,
    path: str,
    checkpoint: str | None = None,
    file_format: str = "parquet",
    trigger: dict | None = None,
    groups: int | None = None,
) -> StreamingQuery | None:
    """Results in one folder per road segment; a batch replaces the segments it writes.

    With ``groups`` segments share that many folders (``segment_group=``), by their hash: the
    number of files does not follow the number of segments. Rows there are sorted by segment, so
    ``read_segment`` opens one folder, and of its files only what the statistics leave.
    """
    if groups is None:
        return _write(results, path, "segment_id", checkpoint, file_format, trigger)
    rows = results.withColumn("segment_group", segment_group(F.col("segment_id"), groups))
    if rows.isStreaming:
        return _write(rows, path, "segment_group", checkpoint, file_format, trigger)
    rows = _with_others(rows, path, file_format, "segment_group", "segment_id")
    rows = rows.hint("rebalance", "segment_group").sortWithinPartitions("segment_group", "segment_id")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _capped(writer.partitionBy("segment_group").format(file_format)).save(path)
    return None


def segment_group(segment_id: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(segment_id), F.lit(groups)).cast("int")


def read_segment(
    spark: SparkSession, path: str, segment_id: str, groups: int, file_format: str = "parquet"
) -> DataFrame:
    """Results of one segment that ``write_by_segment`` has put into ``groups``."""
    group = spark.range(1).select(segment_group(F.lit(segment_id), groups)).first()[0]
    rows = spark.read.format(file_format).load(path)
    return rows.where((F.col("segment_group") == group) & (F.col("segment_id") == segment_id)).drop("segment_group")


def write_console(results: DataFrame, trigger: dict | None = None) -> StreamingQuery | None:
    """Print results; a stream prints each batch."""
    if not results.isStreaming:
        results.show(truncate=False)
        return None
    writer = results.writeStream.format("console").option("truncate", "false")
    return _started(writer.outputMode("append"), trigger)


def write_tsv(events_as_lines: DataFrame, path: str, mode: str = "error") -> None:
    """Text export of ``clean.to_tsv_line`` (batch), gzip-compressed."""
    events_as_lines.write.mode(mode).option("compression", "gzip").text(path)


def _write(
    rows: DataFrame,
    path: str,
    folder: str,
    checkpoint: str | None,
    file_format: str,
    trigger: dict | None,
) -> StreamingQuery | None:
    if not rows.isStreaming:
        rows = rows.hint("rebalance", folder)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        _capped(writer.partitionBy(folder).format(file_format)).save(path)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    rows = rows.repartition(F.col(folder))
    writer = _capped(rows.writeStream.format(file_format).partitionBy(folder))
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return _started(writer.outputMode("append"), trigger)


def _capped(writer):
    return writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)


def _started(writer, trigger: dict | None) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()
