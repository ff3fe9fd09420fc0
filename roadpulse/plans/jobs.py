"""The four programs: replay files to a topic, count per grid cell into folders or into
a search index, and report traffic per road segment.

A finite set of files is a batch: every record is parsed once, good and rejected ones are
stored with the reason, and all windows are reported. Streams are for open-ended sources;
they report a window when the watermark has passed its end, and return the running query.
``late_rows`` tells what a query dropped as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.clean import split_valid, store_split, stored_good
from roadpulse.operators.roads import RoadIndex, match_roads
from roadpulse.operators.traffic import grid_traffic, road_traffic
from roadpulse.schema import GRID, ROAD_SCHEMA, Grid
from roadpulse.sinks.documents import write_documents, write_search_index
from roadpulse.sinks.files import write_bucketed, write_by_segment, write_console
from roadpulse.sinks.kafka import write_fcd_kafka
from roadpulse.session import scratch_path
from roadpulse.sources.files import parsed_fcd_tsv, stream_fcd
from roadpulse.sources.kafka import parsed_fcd_kafka
from roadpulse.streaming.event_time import MAX_DELAY, with_fcd_watermark

DRAIN = {"availableNow": True}


def grid_report(
    events: DataFrame, minutes: int, grid: Grid = GRID, delay: str = MAX_DELAY
) -> DataFrame:
    """Events to counts per cell and window; batch or stream."""
    return grid_traffic(with_fcd_watermark(events, delay), minutes, grid)


def road_report(
    events: DataFrame,
    roads: DataFrame | RoadIndex,
    minutes: int = 2,
    max_dist: float = 0.001,
    delay: str = MAX_DELAY,
) -> DataFrame:
    """Events to flow and speed per road segment and window; batch or stream.

    Matching keeps no state, so one windowed aggregation is the only shuffle of events
    when the road index is broadcast.
    """
    return road_traffic(match_roads(with_fcd_watermark(events, delay), roads, max_dist), minutes)


def load_files(
    spark: SparkSession, path: str, parsed_path: str | None = None, partitions: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events, rejected lines) of text files, read and parsed once and stored under
    ``parsed_path`` (default: a folder in the shared scratch folder)."""
    stored = parsed_path or scratch_path(spark, "parsed")
    return store_split(parsed_fcd_tsv(spark, path, partitions), stored)


def produce(
    spark: SparkSession, path: str, brokers: str, topic: str, parsed_path: str | None = None
) -> DataFrame:
    """Text files to a topic. Returns the rejected lines."""
    events, rejected = load_files(spark, path, parsed_path)
    write_fcd_kafka(events, brokers, topic)
    return rejected


def file_events(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the good events in a folder of text files."""
    return split_valid(stream_fcd(spark, folder, files_per_trigger))[0]


def store_topic(
    spark: SparkSession, brokers: str, topic: str, parsed_path: str, checkpoint: str
) -> StreamingQuery:
    """Topic to stored good and rejected records, decoded once."""
    return store_split(parsed_fcd_kafka(spark, brokers, topic), parsed_path, checkpoint)


def _topic_events(
    spark: SparkSession, brokers: str, topic: str, parsed_path: str | None, checkpoint: str
) -> DataFrame:
    """Good events of a topic. With ``parsed_path`` they are those a second query stores
    there beside the rejected ones."""
    if parsed_path is None:
        return split_valid(parsed_fcd_kafka(spark, brokers, topic))[0]
    store_topic(spark, brokers, topic, parsed_path, f"{checkpoint.rstrip('/')}-parsed")
    return stream_fcd(spark, stored_good(parsed_path), file_format="parquet")


def consume_to_folders(
    spark: SparkSession,
    brokers: str,
    topic: str,
    minutes: int,
    sink: str,
    checkpoint: str,
    parsed_path: str | None = None,
) -> StreamingQuery:
    """Topic to counts per cell, one folder per window."""
    events = _topic_events(spark, brokers, topic, parsed_path, checkpoint)
    return write_bucketed(grid_report(events, minutes), sink, checkpoint)


def consume_to_search(
    spark: SparkSession,
    brokers: str,
    topic: str,
    minutes: int,
    nodes: str,
    checkpoint: str,
    parsed_path: str | None = None,
) -> StreamingQuery:
    """Topic to counts per cell as search documents."""
    events = _topic_events(spark, brokers, topic, parsed_path, checkpoint)
    return write_search_index(grid_report(events, minutes), nodes, checkpoint=checkpoint)


def grid_from_files(
    spark: SparkSession,
    folder: str,
    minutes: int,
    sink: str,
    documents: bool = False,
    parsed_path: str | None = None,
    level: str = "day",
) -> DataFrame:
    """A finite folder of text files to counts per cell of all windows, in one folder per
    ``level`` of them. Returns the rejected lines."""
    events, rejected = load_files(spark, folder, parsed_path)
    write = write_documents if documents else write_bucketed
    write(grid_traffic(events, minutes), sink, level=level)
    return rejected


def stream_grid_from_files(
    spark: SparkSession,
    folder: str,
    minutes: int,
    sink: str,
    checkpoint: str,
    documents: bool = False,
    trigger: dict | None = None,
    level: str = "minute",
) -> StreamingQuery:
    """Text files that keep arriving in a folder to counts per cell of the closed windows."""
    report = grid_report(file_events(spark, folder), minutes)
    write = write_documents if documents else write_bucketed
    return write(report, sink, checkpoint, trigger=trigger, level=level)


def map_match(
    spark: SparkSession,
    folder: str,
    roads_path: str,
    minutes: int = 2,
    max_dist: float = 0.001,
    sink: str | None = None,
    parsed_path: str | None = None,
) -> DataFrame:
    """A finite folder of text files and a road table to traffic per segment in all
    windows, on the console or in one folder per segment. Returns the rejected lines."""
    events, rejected = load_files(spark, folder, parsed_path)
    roads = spark.read.schema(ROAD_SCHEMA).parquet(roads_path)
    report = road_traffic(match_roads(events, roads, max_dist), minutes)
    if sink is None:
        write_console(report)
    else:
        write_by_segment(report, sink)
    return rejected


def stream_map_match(
    spark: SparkSession,
    events: DataFrame,
    roads: DataFrame | RoadIndex,
    minutes: int = 2,
    max_dist: float = 0.001,
    sink: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A stream of events, of files or of a topic, to traffic per segment in the closed
    windows."""
    report = road_report(events, roads, minutes, max_dist)
    if sink is None:
        return write_console(report, trigger)
    return write_by_segment(report, sink, checkpoint, trigger=trigger)
