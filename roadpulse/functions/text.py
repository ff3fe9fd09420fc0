"""Parsing and printing of record fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.schema import EVENT_TIME_FORMAT, WINDOW_TIME_FORMAT

EVENT_TIME_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,3}$"


def parse_event_time(value: Column) -> Column:
    """Timestamp of ``yyyy-MM-dd HH:mm:ss.SSS`` text, NULL for any other form."""
    return F.when(value.rlike(EVENT_TIME_PATTERN), value.try_cast("timestamp"))


def parse_whole(value: Column) -> Column:
    """32-bit integer, NULL when the text is anything else (blanks included)."""
    return F.when(value == F.trim(value), value.try_cast("int"))


def print_event_time(value: Column) -> Column:
    return F.date_format(value, EVENT_TIME_FORMAT)


def print_window_time(value: Column) -> Column:
    return F.date_format(value, WINDOW_TIME_FORMAT)
