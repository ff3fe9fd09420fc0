"""One event as a message, by Spark's own functions.

``avro``: Avro binary without header bytes; needs Spark's Avro package on the class path,
and without it the first use is an error that names the package.
``json``: a JSON object as text; needs nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro, to_avro

from roadpulse.functions.text import print_event_time
from roadpulse.schema import EVENT_AVRO, EVENT_COLUMNS, EVENT_SCHEMA

# The event with its time as text.
MESSAGE = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
        for f in EVENT_SCHEMA
    ]
)
LAYOUTS = ("avro", "json")


def encode_event(layout: str = "avro") -> Column:
    """The event columns of a row as one value; the time travels as text."""
    _check(layout)
    fields = {name: F.col(name) for name in EVENT_COLUMNS}
    fields["timestamp"] = print_event_time(F.col("timestamp"))
    record = F.struct(*(value.alias(name) for name, value in fields.items()))
    if layout == "json":
        return F.to_json(record)
    return to_avro(record, EVENT_AVRO)


def decode_event(value: Column, layout: str = "avro") -> Column:
    """Struct of the event fields; the time is text. NULL or fields of NULL for a value
    that cannot be read."""
    _check(layout)
    if layout == "json":
        return F.from_json(value.cast("string"), MESSAGE, {"mode": "PERMISSIVE"})
    return from_avro(value, EVENT_AVRO, {"mode": "PERMISSIVE"})


def _check(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
