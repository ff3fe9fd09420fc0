"""Turning text records into events.

A parsed DataFrame holds the event columns, the original ``line`` and ``reject``: NULL
for a good record, else the reason. ``operators.clean.split_valid`` separates the two.
All functions here work on batch and streaming input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.text import parse_event_time, parse_whole
from roadpulse.operators.clean import drop_unidentified
from roadpulse.schema import DEFAULTS, EVENT_COLUMNS, GPS_SCHEMA, JSON_SCHEMA

# Beyond it the archive layout cannot hold a value, and NaN and infinities are no values.
LARGEST_MEASURE = 2.0**31
OBJECT = r"\{[^{}]*\}"
# What is left of arrays without their objects.
FRAME = r"\A\s*(\[[\s,]*\]\s*)*\z"


def parse_tsv(lines: DataFrame, column: str = "value") -> DataFrame:
    """Tab-separated records of 8 fields. Empty measures become 0; the id and the time
    have to be there."""
    fields = F.split(F.col(column), "\t", -1)
    token = {name: F.get(fields, F.lit(i)) for i, name in enumerate(EVENT_COLUMNS)}
    parsed = {
        "device_id": parse_whole(token["device_id"]),
        "timestamp": parse_event_time(token["timestamp"]),
        **{name: _default_if_empty(name, token[name]) for name in DEFAULTS},
    }
    records = lines.select(
        *(value.alias(name) for name, value in parsed.items()),
        F.col(column).alias("line"),
        F.size(fields).alias("_fields"),
    )
    reject = F.when(F.col("_fields") != len(EVENT_COLUMNS), "field count")
    return records.select(*EVENT_COLUMNS, "line", _first_missing(reject).alias("reject"))


def parse_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """One JSON object per row."""
    record = F.from_json(F.col(column), JSON_SCHEMA)
    rows = lines.select(record.alias("_record"), F.col(column).alias("line"))
    return json_events(rows.select("_record.*", "line"))


def parse_json_array(files: DataFrame, column: str = "value") -> DataFrame:
    """One text per row that holds an array of flat objects, or several arrays.

    Each whole object is a record with its own text as ``line``, also in a damaged array;
    what is left over apart from the array's punctuation is rejected.
    """
    whole = F.regexp_extract_all(F.col(column), F.lit(OBJECT), F.lit(0))
    left = F.regexp_replace(F.col(column), OBJECT, "")
    left = F.when(~left.rlike(FRAME), left)
    records = files.select(F.explode(F.array_append(whole, left)).alias("line"))
    records = records.where(F.col("line").isNotNull())
    parsed = parse_json(records, "line")
    broken = ~F.col("line").rlike(r"\A\{")
    return parsed.withColumn("reject", F.when(broken, "array").otherwise(F.col("reject")))


def json_events(records: DataFrame) -> DataFrame:
    """Events of JSON records that were read with ``JSON_SCHEMA``.

    Records with an empty vehicle id are dropped; the speed is cut to a whole number;
    absent measures become 0.
    """
    if "line" not in records.columns:
        records = records.withColumn("line", F.to_json(F.struct(*records.columns)))
    # A record without the id field is broken, not unidentified: it is kept to be rejected.
    known = records.withColumn("device_random_id", F.coalesce("device_random_id", F.lit("?")))
    kept = drop_unidentified(known)
    measures = {name: _default_if_empty(name, F.coalesce(name, F.lit(""))) for name in DEFAULTS}
    speed = measures["speed"]
    measures["speed"] = F.when(speed < 0, F.ceil(speed)).otherwise(F.floor(speed)).cast("double")
    events = kept.select(
        parse_whole(F.col("device_random_id")).alias("device_id"),
        parse_event_time(F.col("recorded_timestamp")).alias("timestamp"),
        *(value.alias(name) for name, value in measures.items()),
        "line",
    )
    return events.select(*EVENT_COLUMNS, "line", _first_missing().alias("reject"))


def parse_gps_csv(lines: DataFrame, column: str = "value") -> DataFrame:
    """Comma-separated archive records of 12 fields; text fields are kept as they are."""
    fields = F.split(F.col(column), ",", -1)
    values = []
    for i, field in enumerate(GPS_SCHEMA):
        token = F.get(fields, F.lit(i))
        kind = field.dataType.simpleString()
        parse = {"int": parse_whole, "double": _measure}
        values.append(parse.get(kind, lambda t: t)(token).alias(field.name))
    records = lines.select(*values, F.col(column).alias("line"), F.size(fields).alias("_fields"))
    reject = F.when(F.col("_fields") != len(GPS_SCHEMA), "field count")
    for field in GPS_SCHEMA:
        reject = reject.when(F.col(field.name).isNull(), field.name)
    return records.select(*GPS_SCHEMA.fieldNames(), "line", reject.alias("reject"))


def gps_events(records: DataFrame) -> DataFrame:
    """Events of archive records."""
    return records.select(
        "device_id",
        parse_event_time(F.col("recorded_timestamp")).alias("timestamp"),
        F.col("longitude").alias("lon"),
        F.col("latitude").alias("lat"),
        "altitude",
        F.col("speed").cast("double").alias("speed"),
        "orientation",
        "transfer",
    )


def _default_if_empty(name: str, token: Column) -> Column:
    """Number of an optional field: its default for an empty text, NULL for a bad one."""
    default = DEFAULTS[name]
    number = parse_whole(token) if isinstance(default, int) else _measure(token)
    return F.when(token == "", F.lit(default)).otherwise(number)


def _measure(token: Column) -> Column:
    """A finite number that a measure of a car can be, or NULL."""
    number = token.try_cast("double")
    return F.when(F.abs(number) < LARGEST_MEASURE, number)


def _first_missing(reject: Column | None = None) -> Column:
    """Name of the first event column without a value."""
    for name in EVENT_COLUMNS:
        missing = F.col(name).isNull()
        reject = F.when(missing, name) if reject is None else reject.when(missing, name)
    return reject
