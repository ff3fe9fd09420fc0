"""File readers, batch and stream. Paths may be on any Hadoop file system; ``.gz`` files
are unzipped while reading (a gz file is one task, so ship many of them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.clean import split_valid
from roadpulse.schema import EVENT_SCHEMA, GPS_SCHEMA
from roadpulse.sources.records import (
    FRAME,
    gps_events,
    parse_gps_csv,
    parse_json,
    parse_json_array,
    parse_tsv,
)

COMPRESSED = "gz,bz2,zst,lz4,snappy,deflate"


def parsed_fcd_tsv(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Parsed records with ``reject`` of tab-separated text.

    ``partitions`` deals the lines out anew before they are parsed: for a few large gz
    files, each of which is read by one task.
    """
    lines = spark.read.text(path)
    return parse_tsv(lines if partitions is None else lines.repartition(partitions))


def read_fcd_tsv(
    spark: SparkSession, path: str, partitions: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events, rejected lines) of tab-separated text."""
    return split_valid(parsed_fcd_tsv(spark, path, partitions))


def read_fcd_json(
    spark: SparkSession, path: str, layout: str = "array"
) -> tuple[DataFrame, DataFrame]:
    """(events, rejected records) of JSON files.

    ``layout="array"``: arrays of flat objects, see ``parsed_json_arrays``.
    ``layout="lines"``: one object per line.
    """
    if layout == "lines":
        return split_valid(parse_json(spark.read.text(path)))
    if layout != "array":
        raise ValueError(f"layout must be array or lines, got {layout!r}")
    return split_valid(parsed_json_arrays(spark, path))


def parsed_json_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Parsed records of files that hold an array of flat objects, or several.

    A file is cut at the closing braces, which Spark does at any place of it, so that many
    tasks read one array. A piece is a record from its last opening brace on. What is
    before that brace, apart from commas and white space, and the rest of a piece without
    one, is the frame of the array or damage; it is put together for each file and rejected
    as one line unless it is the brackets of arrays. A last record that is cut off is part
    of the damage: the sizes of the pieces tell whether a brace ends the file.

    Compressed files cannot be cut: each is one text and one task.
    """
    packed = spark.read.option("wholetext", True).option("pathGlobFilter", f"*.{{{COMPRESSED}}}").text(path)
    pieces = _pieces(spark, path)
    frames = _frames(pieces)
    cut = frames.where("cut").select("_file", F.col("last_at").alias("_at"))
    whole = pieces.where(F.col("_opens")).join(cut, ["_file", "_at"], "left_anti")
    record = F.concat(F.lit("{"), F.substring_index("value", "{", -1), F.lit("}"))
    records = parse_json(whole.select(record.alias("line")), "line")
    damage = frames.where(~F.col("frame").rlike(FRAME)).select(
        F.col("frame").alias("line"), F.lit("array").alias("reject")
    )
    both = records.unionByName(damage, allowMissingColumns=True)
    return both.unionByName(parse_json_array(packed.select("value")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Texts before each closing brace (and after the last), with their file and place."""
    packed = F.col("_metadata.file_name").rlike(rf"\.({COMPRESSED.replace(',', '|')})$")
    rows = spark.read.option("lineSep", "}").text(path).where(~packed)
    return rows.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_size").alias("_size"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_at"),
        F.contains("value", F.lit("{")).alias("_opens"),
    )


def _frames(pieces: DataFrame) -> DataFrame:
    """One row for each file: ``frame``, all that belongs to no record but commas inside
    arrays; ``last_at`` and whether a last record is ``cut``."""
    head = F.expr("left(value, length(value) - length(substring_index(value, '{', -1)) - 1)")
    rest = F.when(F.col("_opens"), head).otherwise(F.concat("value", F.lit("}")))
    placed = pieces.withColumn("_rest", rest)
    plain = F.col("_rest").rlike(r"\A[\s,]*\z")
    mark = F.struct("_at", "_rest")
    facts = placed.groupBy("_file").agg(
        # A byte order mark is not part of the first piece.
        (F.max("_size") - F.sum(F.octet_length("value") + 1)).alias("missing"),
        F.max("_at").alias("last_at"),
        F.max_by(F.struct("value", "_rest", "_opens"), "_at").alias("last"),
        F.collect_list(F.when(~plain, mark)).alias("marks"),
        F.min(F.when(plain & F.contains("_rest", F.lit(",")), F.col("_at"))).alias("comma"),
    )
    open_end = F.col("missing").isin(-1, 2)
    inner = F.filter(F.array_sort("marks"), lambda m: m["_at"] != F.col("last_at"))
    outside = F.col("comma") < F.coalesce(F.get(inner, F.lit(0))["_at"], F.col("last_at"))
    parts = F.concat(
        F.array(F.when(outside, ",").otherwise("")),
        F.transform(inner, lambda m: m["_rest"]),
        F.array(F.when(open_end, F.col("last.value")).otherwise(F.col("last._rest"))),
    )
    return facts.select(
        "_file",
        "last_at",
        (open_end & F.col("last._opens")).alias("cut"),
        F.array_join(parts, "").alias("frame"),
    )


def read_gps_csv(
    spark: SparkSession, path: str, header: bool | str = False
) -> tuple[DataFrame, DataFrame]:
    """(archive records, rejected lines) of comma-separated text.

    ``header``: lines of exactly this text are left out; True stands for the names of the
    archive columns. Any other line that is no record is rejected.
    """
    lines = spark.read.text(path)
    if header:
        text = ",".join(GPS_SCHEMA.fieldNames()) if header is True else header
        lines = lines.where(F.rtrim("value") != text)
    return split_valid(parse_gps_csv(lines))


def read_gps_events(spark: SparkSession, path: str, header: bool | str = False) -> DataFrame:
    return gps_events(read_gps_csv(spark, path, header)[0])


def stream_fcd(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    file_format: str = "text",
) -> DataFrame:
    """Stream of the files that appear in a folder, oldest first.

    ``text``: parsed records with ``reject``; ``parquet``: events. A cap on the files of a
    batch bounds its size, but windows are closed between batches: rows that come more than
    the allowed delay after a row of an earlier batch are late. Without a cap the files that
    are there are one batch. For a finite folder use the batch readers.
    """
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if file_format == "text":
        return parse_tsv(reader.text(path))
    if file_format == "parquet":
        return reader.schema(EVENT_SCHEMA).parquet(path)
    raise ValueError(f"file_format must be text or parquet, got {file_format!r}")
