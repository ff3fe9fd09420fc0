"""

Every query runs over a whole test table. The SQL is written another way than the
operators where that is possible: the grid by a join with its lines, geohash bits by
lists, matching by comparing all pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.geohash import ALPHABET
from roadpulse.functions.text import print_event_time
from roadpulse.operators import clean, geohash, grid, roads, traffic
from roadpulse.plans import jobs, views
from roadpulse.plans.views import COPIES_SQL, EVENTS_SQL, EXTREMES_SQL, HOT_SQL, RAW_SQL, ROADS_SQL
from roadpulse.schema import EVENT_COLUMNS, EVENT_SCHEMA
from roadpulse.session import materialize, scratch_path
from roadpulse.sinks import documents, files, kafka
from roadpulse.sources import files as sources
from roadpulse.sources import records
from roadpulse.sources.kafka import from_messages
from roadpulse.streaming.quality import QualityLedger, quality_totals
from roadpulse.streaming.event_time import split_late, stored_events, with_fcd_watermark

# The subpackage for language-model data may be absent; nothing else needs it.
try:
    from roadpulse.llm import registry as llm
except ImportError:
    llm = None

MAX_DIST = 0.001
CROWDED_DIST = 0.01
DAY = 24 * 60
ARRAY_RECORDS = 1000
FILE_ARRAYS = 16
FILE_EVENTS = 2_000_000
SEGMENT_GROUPS = 32
# Far enough for every delay used here.
TICK = timedelta(days=400)


def entry(spark: SparkSession) -> DataFrame:
    """Vehicles per grid cell and 2-minute window."""
    return grid_2min(spark, "/root/testdata/sf0.001")


# --- queries -------------------------------------------------------------------------


def grid_2min(spark: SparkSession, sf: str) -> DataFrame:
    return traffic.grid_traffic(views.fcd_events(spark, sf), 2)


def grid_1day(spark: SparkSession, sf: str) -> DataFrame:
    return traffic.grid_traffic(views.fcd_events(spark, sf), DAY)


def grid_cells(spark: SparkSession, sf: str) -> DataFrame:
    located = grid.with_cell(views.fcd_events(spark, sf))
    return located.select("event_id", "cellid", "in_bbox")


def cell_centres(spark: SparkSession, sf: str) -> DataFrame:
    cells = grid.with_cell(views.fcd_events(spark, sf)).groupBy("cellid").count()
    return grid.with_cell_centre(cells.select("cellid"))


def grid_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents.with_document_id(documents.to_documents(grid_1day(spark, sf)))


def grid_folders(spark: SparkSession, sf: str) -> DataFrame:
    report = grid_2min(spark, sf)
    line = files.row_text(report.select("cellid", "vehicles", "timestamp"))
    return report.select(files.minute_bucket(F.col("timestamp")).alias("bucket"), line.alias("line"))


def grid_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "grid-overwrite")
    for _ in range(2):
        files.write_overwrite(grid_1day(spark, sf), path)
    return spark.read.parquet(path)


def grid_folders_written(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "grid-folders")
    for _ in range(2):
        files.write_bucketed(grid_1day(spark, sf), path, file_format="parquet")
    return spark.read.parquet(path).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("vehicles").alias("vehicles")
    )


def grid_windows_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Short windows in one folder per day; the second half of them written once more."""
    path = scratch_path(spark, "grid-days")
    report = materialize(grid_2min(spark, sf), "report")
    files.write_bucketed(report, path, file_format="parquet", level="day")
    middle = report.agg(F.percentile_approx(F.col("vehicles") * 0 + F.unix_timestamp("timestamp"), 0.5)).first()[0]
    again = report.where(F.unix_timestamp("timestamp") >= F.lit(middle))
    files.write_bucketed(again, path, file_format="parquet", level="day")
    return spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day"), "bucket").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("vehicles").alias("vehicles")
    )


def documents_written(spark: SparkSession, sf: str) -> DataFrame:
    """Written twice and read again."""
    path = scratch_path(spark, "documents")
    for _ in range(2):
        documents.write_documents(grid_1day(spark, sf), path)
    return spark.read.schema(documents.DOCUMENTS).json(path).drop("day")


def files_grid_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """Events as text files that overlap in time, through the program for files."""
    source, sink = scratch_path(spark, "fcd-text"), scratch_path(spark, "grid-text")
    lines = clean.to_tsv_line(views.fcd_events(spark, sf).repartition(12, "event_id"))
    files.write_tsv(lines, source)
    jobs.grid_from_files(spark, source, 2, sink)
    return spark.read.text(sink).select(F.col("value").alias("line"))


def tsv_split_written(spark: SparkSession, sf: str) -> DataFrame:
    """Good and rejected records stored in one pass."""
    good, bad = clean.store_split(_tsv_records(spark, sf), scratch_path(spark, "split"))
    good = good.select(F.lit(None).cast("string").alias("reject"))
    return clean.reject_counts(good.union(bad.select("reject")))


def json_array_file(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of records in files, one of them cut short in its last record."""
    events = views.fcd_raw(spark, sf)
    record = F.struct("event_id", *_json_fields())
    # The arrays grow in number with the table, not in length.
    part = (F.col("event_id") % 8).alias("part")
    block = F.floor(F.col("event_id") / (8 * ARRAY_RECORDS)).alias("block")
    arrays = events.groupBy(part, block).agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(record)), lambda r: r)).alias("value"),
        F.max("event_id").alias("last"),
    )
    last = events.where(F.col("event_id") % 8 == 0).agg(F.max("event_id")).first()[0]
    cut = F.substring("value", F.lit(1), F.length("value") - 10)
    value = F.when(F.col("last") == F.lit(last), cut).otherwise(F.col("value"))
    path = scratch_path(spark, "arrays")
    writer = arrays.select(value.alias("value")).write
    writer.option("maxRecordsPerFile", FILE_ARRAYS).text(path)
    good, bad = sources.read_fcd_json(spark, path)
    return _printed(good).select("*", F.lit(None).cast("string").alias("reject")).unionByName(
        bad.select("reject"), allowMissingColumns=True
    )


def archive_header_file(spark: SparkSession, sf: str) -> DataFrame:
    """Archive files with a header and a line that is no record in each."""
    archive = clean.to_gps_columns(views.fcd_events(spark, sf))
    lines = archive.select(F.concat_ws(",", *archive.columns).alias("value"))
    other = spark.createDataFrame([(",".join(archive.columns),), ("no,record",)], "value string")
    path = scratch_path(spark, "archive")
    for part in (0, 1):
        rows = lines.where(F.crc32("value") % 2 == part)
        other.union(rows).write.mode("append").text(path)
    good, bad = sources.read_gps_csv(spark, path, header=True)
    good = good.select(F.lit(None).cast("string").alias("reject"))
    return clean.reject_counts(good.union(bad.select("reject")))


def gps_events(spark: SparkSession, sf: str) -> DataFrame:
    return _printed(records.gps_events(parse_gps_csv(spark, sf)))


def covering_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of mixed precision, decoded by their tags."""
    cells = geohash.covering_geohash(views.fcd_events(spark, sf))
    return geohash.with_geohash_bounds(cells.select("device_id", "geohash_long"))


def covering_shifted(spark: SparkSession, sf: str) -> DataFrame:
    cells = geohash.covering_geohash(views.fcd_events(spark, sf)).select("device_id", "geohash_long")
    moved = geohash.shift_geohash(cells, -2, 3)
    plain = geohash.untag_geohash(moved.withColumn("plain", F.col("geohash_long")), "plain")
    return plain.select("device_id", "geohash_long", "plain", "precision")


def bbox_flag(spark: SparkSession, sf: str) -> DataFrame:
    return clean.in_bbox(views.fcd_events(spark, sf)).select("event_id", "in_bbox")


def bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _printed(clean.filter_bbox(views.fcd_events(spark, sf)))


def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return _printed(clean.fill_defaults(views.fcd_raw(spark, sf)))


def gps_columns(spark: SparkSession, sf: str) -> DataFrame:
    return clean.to_gps_columns(views.fcd_extremes(spark, sf))


def tsv_lines(spark: SparkSession, sf: str) -> DataFrame:
    return clean.to_tsv_line(views.fcd_events(spark, sf))


def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    return _printed(clean.dedup_events(views.fcd_copies(spark, sf)))


def geohash_points(spark: SparkSession, sf: str) -> DataFrame:
    located = geohash.with_geohash(views.fcd_events(spark, sf), 20)
    located = geohash.with_geohash(located, 60, "geohash_60")
    located = geohash.with_geohash_long(located, 33)
    return located.select("event_id", "geohash", "geohash_60", "geohash_long")


def geohash_density(spark: SparkSession, sf: str) -> DataFrame:
    return geohash.geohash_density(views.fcd_events(spark, sf), 30)


def geohash_long(spark: SparkSession, sf: str) -> DataFrame:
    return geohash.geohash_long_density(views.fcd_events(spark, sf), 33)


def geohash_bounds(spark: SparkSession, sf: str) -> DataFrame:
    cells = geohash.geohash_long_density(views.fcd_events(spark, sf), 33)
    return geohash.with_geohash_bounds(cells, 33)


def geohash_text_bounds(spark: SparkSession, sf: str) -> DataFrame:
    cells = geohash.geohash_density(views.fcd_events(spark, sf), 30)
    return geohash.with_geohash_bounds(cells, 30, "geohash")


def geohash_shifted(spark: SparkSession, sf: str) -> DataFrame:
    cells = geohash.geohash_long_density(views.fcd_events(spark, sf), 33)
    return geohash.shift_geohash(cells, 3, -2, 33)


def geohash_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return geohash.geohash_neighbour_density(views.fcd_events(spark, sf), 30)


def covering_geohash(spark: SparkSession, sf: str) -> DataFrame:
    return geohash.covering_geohash(views.fcd_events(spark, sf))


def geohash_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return geohash.geohash_rollup(views.fcd_events(spark, sf), 4, 5, 6)


def geohash_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(traffic.geohash_traffic(views.fcd_events(spark, sf), 20, 2))


def geohash_traffic_1day(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(traffic.geohash_traffic(views.fcd_events(spark, sf), 20, DAY))


def match_roads(spark: SparkSession, sf: str) -> DataFrame:
    matched = roads.match_roads(views.fcd_events(spark, sf), views.fcd_roads(spark, sf), MAX_DIST)
    return matched.select("event_id", "segment_id", F.round("distance", 12).alias("distance"))


def match_roads_audit(spark: SparkSession, sf: str) -> DataFrame:
    matched = roads.match_roads(
        views.fcd_events(spark, sf), views.fcd_roads(spark, sf), MAX_DIST, how="left"
    )
    return matched.select("event_id", "segment_id")


def match_roads_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """As ``match_roads`` with a road index taken as too large to broadcast."""
    index = roads.build_road_index(views.fcd_roads(spark, sf), MAX_DIST)
    matched = roads.match_roads(views.fcd_events(spark, sf), index, broadcast_bytes=0, salts=4)
    return matched.select("event_id", "segment_id")


def match_roads_crowded(spark: SparkSession, sf: str) -> DataFrame:
    """A reach so large that most cells are divided, some of them for good."""
    index = roads.build_road_index(views.fcd_roads(spark, sf), CROWDED_DIST, deepest=1)
    return roads.match_roads(views.fcd_events(spark, sf), index).select("event_id", "segment_id")


def match_roads_crowded_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    index = roads.build_road_index(views.fcd_roads(spark, sf), CROWDED_DIST)
    matched = roads.match_roads(views.fcd_events(spark, sf), index, broadcast_bytes=0, salts=4)
    return matched.select("event_id", "segment_id")


def road_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        jobs.road_report(views.fcd_events(spark, sf), views.fcd_roads(spark, sf), 2, MAX_DIST)
    )


def road_traffic_1day(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        jobs.road_report(views.fcd_events(spark, sf), views.fcd_roads(spark, sf), DAY, MAX_DIST)
    )


def road_topics(spark: SparkSession, sf: str) -> DataFrame:
    routed = kafka.route_by_segment(road_traffic_1day(spark, sf))
    return routed.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("messages"))


def parse_tsv(spark: SparkSession, sf: str) -> DataFrame:
    return _printed(clean.split_valid(_tsv_records(spark, sf))[0])


def tsv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return clean.reject_counts(_tsv_records(spark, sf))


def parse_json(spark: SparkSession, sf: str) -> DataFrame:
    events = views.fcd_raw(spark, sf)
    lines = events.select(F.to_json(F.struct(*_json_fields())).alias("value"))
    return _printed(clean.split_valid(records.parse_json(lines))[0])


def parse_gps_csv(spark: SparkSession, sf: str) -> DataFrame:
    archive = clean.to_gps_columns(views.fcd_events(spark, sf))
    lines = archive.select(F.concat_ws(",", *archive.columns).alias("value"))
    return clean.split_valid(records.parse_gps_csv(lines))[0]


def _json_fields() -> list:
    """Fields of a JSON record; every 19th vehicle does not identify itself."""
    name = F.when(F.col("event_id") % 19 == 0, "").otherwise(F.col("device_id").cast("string"))
    time = print_event_time(F.col("timestamp")).alias("recorded_timestamp")
    return [name.alias("device_random_id"), time, *clean.DEFAULTS]


def message_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Messages in the JSON layout; the Avro layout needs a package."""
    events = views.fcd_events(spark, sf)
    return _printed(from_messages(kafka.to_messages(events, "json"), "json"))


def stream_grid_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream in several batches; all windows."""
    report = jobs.grid_report(_event_stream(spark, sf), 2)
    path = scratch_path(spark, "stream-grid")
    _drain(spark, report, path)
    return spark.read.parquet(path)


def stream_road_traffic(spark: SparkSession, sf: str) -> DataFrame:
    report = jobs.road_report(
        _event_stream(spark, sf), views.fcd_roads(spark, sf), DAY, MAX_DIST
    )
    path = scratch_path(spark, "stream-road")
    _drain(spark, report, path)
    return _rounded(spark.read.parquet(path))


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Copies that differ, some of them in a later batch than the others."""
    copies = views.fcd_copies(spark, sf)
    third = _third(copies)
    moved = F.least(third + ((F.col("event_id") % 14 == 0) & (F.col("speed") > 50)).cast("int"), F.lit(2))
    stream = _arrivals(spark, copies, moved)
    path = scratch_path(spark, "stream-dedup")
    delay = f"{_length(copies) // 1_000_000 + 60} seconds"
    _drain(spark, clean.dedup_events(with_fcd_watermark(stream, delay)), path)
    return _printed(spark.read.parquet(path))


def stream_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Two windowed aggregations in a row."""
    events = with_fcd_watermark(_event_stream(spark, sf))
    path = scratch_path(spark, "stream-neighbours")
    _drain(spark, geohash.geohash_neighbour_density(events, 30, DAY), path)
    return spark.read.parquet(path)


def neighbours_1day(spark: SparkSession, sf: str) -> DataFrame:
    return geohash.geohash_neighbour_density(views.fcd_events(spark, sf), 30, DAY)


def stream_rollup(spark: SparkSession, sf: str) -> DataFrame:
    events = with_fcd_watermark(_event_stream(spark, sf))
    path = scratch_path(spark, "stream-rollup")
    _drain(spark, geohash.geohash_rollup_windows(events, DAY, 4, 5, 6), path)
    return spark.read.parquet(path)


def stream_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Good and rejected records as a stream's micro-batches have reported them."""
    source, ledger_path = scratch_path(spark, "lines"), scratch_path(spark, "quality")
    lines = _tsv_records(spark, sf).select("line")
    parts = max(4, lines.count() // FILE_EVENTS)
    lines.repartition(parts).write.text(source)
    ledger = QualityLedger(spark, ledger_path)
    spark.streams.addListener(ledger)
    try:
        watched = clean.observe_quality(
            sources.stream_fcd(spark, source, -(-parts // 3)), "quality", reasons=True
        )
        state = scratch_path(spark, "quality-state")
        query = clean.store_split(watched, scratch_path(spark, "stream-split"), state, jobs.DRAIN)
        query.awaitTermination()
        ledger.wait(query)
    finally:
        spark.streams.removeListener(ledger)
    return quality_totals(spark, ledger_path)


def segments_written(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic of segments in hashed folders, written twice; the counts of each segment."""
    path = scratch_path(spark, "segments")
    report = materialize(road_traffic_1day(spark, sf), "report")
    for _ in range(2):
        files.write_by_segment(report, path, groups=SEGMENT_GROUPS)
    stored = spark.read.parquet(path)
    return stored.groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("vehicles").alias("vehicles")
    )


def match_roads_hot(spark: SparkSession, sf: str) -> DataFrame:
    """A third of all events at one spot, and an index taken as too large to broadcast."""
    events = views.fcd_hot(spark, sf)
    index = roads.build_road_index(views.fcd_roads(spark, sf), MAX_DIST)
    matched = roads.match_roads(events, index, broadcast_bytes=0)
    return matched.select("event_id", "segment_id")


def late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every twentieth event arrives a batch later than its time; on-time and late ones are
    the input."""
    events = views.fcd_events(spark, sf)
    arrival = F.least(_third(events) + (F.col("event_id") % 20 == 0).cast("int"), F.lit(2))
    path = scratch_path(spark, "lateness")
    state = scratch_path(spark, "lateness-state")
    stream = _arrivals(spark, events, arrival, tick=False)
    split_late(stream, path, state, 2, trigger=jobs.DRAIN).awaitTermination()
    return _printed(stored_events(spark, path, EVENT_SCHEMA))


def stream_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of closed windows, batch by batch, read by their ledger."""
    path = scratch_path(spark, "stream-documents")
    report = jobs.grid_report(_event_stream(spark, sf), DAY)
    state = scratch_path(spark, "stream-documents-state")
    documents.write_documents(report, path, state, jobs.DRAIN).awaitTermination()
    return documents.read_documents(spark, path)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events in the order of time, in three batches, and a tick that closes the last
    windows. The tick's own window stays open."""
    events = views.fcd_events(spark, sf)
    return _arrivals(spark, events, _third(events))


def _length(events: DataFrame) -> int:
    """Microseconds from the first to the last event."""
    first, last = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    return (last - first) // timedelta(microseconds=1)


def _third(events: DataFrame) -> Column:
    """Third of the time in which an event is: 0, 1 or 2."""
    first = events.agg(F.min(F.unix_micros("timestamp"))).first()[0]
    step = _length(events) // 3 + 1
    return F.floor((F.unix_micros("timestamp") - F.lit(first)) / F.lit(step)).cast("int")


def _arrivals(spark: SparkSession, events: DataFrame, arrival: Column, tick: bool = True) -> DataFrame:
    """Events as a stream of files, those with one number of ``arrival`` in one batch. The
    number of files follows that of the events; with ``tick`` a row outside the box and
    long after all others is a batch of its own."""
    path = scratch_path(spark, "fcd-stream")
    stored = materialize(events.withColumn("_arrival", arrival), "arrivals")
    files_of_part = max(4, stored.count() // (3 * FILE_EVENTS))
    for part in range(3):
        rows = stored.where(F.col("_arrival") == part).select(*EVENT_COLUMNS)
        rows.repartition(files_of_part).write.mode("append").parquet(path)
    if tick:
        last = stored.agg(F.max("timestamp")).first()[0] + TICK
        late = stored.orderBy("timestamp", "event_id").limit(1).select(*EVENT_COLUMNS)
        outside = {"timestamp": F.lit(last), "lon": F.lit(22.78), "lat": F.lit(40.48)}
        late.withColumns(outside).coalesce(1).write.mode("append").parquet(path)
    return sources.stream_fcd(spark, path, files_per_trigger=files_of_part, file_format="parquet")


def _drain(spark: SparkSession, rows: DataFrame, path: str) -> None:
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", scratch_path(spark, "stream-state"))
    writer.trigger(**jobs.DRAIN).start().awaitTermination()


def _tsv_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as text, with gaps, and with defects in some lines."""
    events = views.fcd_raw(spark, sf)
    field = F.split(clean.tsv_line(), "\t", -1)
    lines = events.select("event_id", field.alias("f"))

    def when(divisor: int, at: int, other) -> F.Column:
        return F.when(F.col("event_id") % divisor == 0, other).otherwise(F.col("f")[at])

    fields = [
        when(29, 0, F.concat(F.lit("x"), F.col("f")[0])),
        when(31, 1, F.substring(F.col("f")[1], 1, 19)),
        when(37, 2, F.lit("east")),
        *(F.col("f")[i] for i in range(3, 7)),
        F.when(F.col("event_id") % 23 != 0, F.col("f")[7]),
    ]
    return records.parse_tsv(lines.select(F.concat_ws("\t", *fields).alias("value")))


def _printed(events: DataFrame) -> DataFrame:
    return events.withColumn("timestamp", print_event_time(F.col("timestamp")))


def _rounded(report: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order in the last digits."""
    return report.withColumn("avg_speed", F.round("avg_speed", 9))


# --- SQL -----------------------------------------------------------------------------

EVENT_TIME = "strftime(timestamp, '%Y-%m-%d %H:%M:%S.%g')"
COLUMNS = f"""event_id, device_id, {EVENT_TIME} AS timestamp, lon, lat, altitude, speed,
              orientation, transfer"""
INSIDE = "lon > 22.8e0 AND lon < 23.05e0 AND lat > 40.5e0 AND lat < 40.7e0"
ROW_HEIGHT = "((40.7e0 - 40.5e0) / 100)"
COL_WIDTH = "((23.05e0 - 22.8e0) / 100)"

# Every event tested against all 100 row lines and all 100 column lines.
LOCATED = f"""
    ev AS ({EVENTS_SQL}),
    lines AS (
        SELECT i, 40.7e0 - {ROW_HEIGHT} * i AS north,
               (40.7e0 - {ROW_HEIGHT} * i) - {ROW_HEIGHT} AS south,
               22.8e0 + {COL_WIDTH} * i AS west,
               (22.8e0 + {COL_WIDTH} * i) + {COL_WIDTH} AS east
        FROM range(100) AS r(i)
    ),
    in_row AS (
        SELECT event_id, min(i) AS r FROM ev JOIN lines ON lat <= north AND lat > south GROUP BY 1
    ),
    in_col AS (
        SELECT event_id, min(i) AS c FROM ev JOIN lines ON lon >= west AND lon < east GROUP BY 1
    ),
    located AS (
        SELECT ev.*, {INSIDE} AS in_bbox,
               CAST(CASE WHEN {INSIDE} THEN r * 100 + c + 1 ELSE 0 END AS INT) AS cellid
        FROM ev LEFT JOIN in_row USING (event_id) LEFT JOIN in_col USING (event_id)
    )
"""
CENTRE = f"""
    40.7e0 - (ceil(cellid / 100) - 0.5e0) * {ROW_HEIGHT} AS lat,
    22.8e0 + (CASE WHEN cellid % 100 = 0 THEN 100 ELSE cellid % 100 END - 0.5e0)
        * {COL_WIDTH} AS lon
"""


def _window_end(minutes: int) -> str:
    width = minutes * 60 * 1_000_000
    return f"make_timestamp((epoch_us(timestamp) // {width} + 1) * {width})"


def _window_label(minutes: int) -> str:
    return f"strftime({_window_end(minutes)}, '%Y-%m-%d %H:%M:%S')"


def _grid_sql(minutes: int) -> str:
    return f"""
        WITH {LOCATED}, counts AS (
            SELECT cellid, {_window_label(minutes)} AS label, count(*) AS vehicles
            FROM located GROUP BY 1, 2
        )
        SELECT cellid, {CENTRE}, vehicles, label AS timestamp FROM counts
    """


def _xy_sql(bits: int, source: str = EVENTS_SQL) -> str:
    nx, ny = (bits + 1) // 2, bits // 2
    fixed = "CAST(floor(({angle} + {half}) * 2147483648e0 / {full}) AS BIGINT) & 2147483647"
    x = fixed.format(angle="lon", half="180e0", full="360e0")
    y = fixed.format(angle="lat", half="90e0", full="180e0")
    return f"SELECT *, ({x}) >> {31 - nx} AS x, ({y}) >> {31 - ny} AS y FROM ({source})"


def _z_sql(bits: int, x: str = "x", y: str = "y") -> str:
    """Interleaved number, one bit at a time from the top: x, y, x, y, ..."""
    terms = []
    for place in range(bits):
        axis, count = (x, (bits + 1) // 2) if place % 2 == 0 else (y, bits // 2)
        bit = count - 1 - place // 2
        terms.append(f"((({axis} >> {bit}) & 1) << {bits - 1 - place})")
    return "(" + " | ".join(terms) + ")"


def _text_sql(number: str, bits: int) -> str:
    chars = [
        f"substr('{ALPHABET}', CAST(({number} >> {shift}) & 31 AS INT) + 1, 1)"
        for shift in range(bits - 5, -1, -5)
    ]
    return "concat(" + ", ".join(chars) + ")"


def _tag_sql(bits: int) -> str:
    return f"(CAST({1 << 62} AS BIGINT) | CAST({1 << bits} AS BIGINT))"


def _cells_sql(bits: int) -> str:
    return f"SELECT x, y, count(*) AS records FROM ({_xy_sql(bits)}) GROUP BY x, y"


def _bounds_sql(bits: int, name: str, value: str) -> str:
    wide, high = float(1 << ((bits + 1) // 2)), float(1 << (bits // 2))
    lat_err, lon_err = f"(90e0 / {high!r}e0)", f"(180e0 / {wide!r}e0)"
    return f"""
        WITH cells AS ({_cells_sql(bits)}), centred AS (
            SELECT {value} AS {name}, records,
                   y / {high!r}e0 * 180e0 - 90e0 + {lat_err} AS lat,
                   x / {wide!r}e0 * 360e0 - 180e0 + {lon_err} AS lon,
                   {lat_err} AS lat_err, {lon_err} AS lon_err
            FROM cells
        )
        SELECT *, lat - lat_err AS min_lat, lat + lat_err AS max_lat,
               lon - lon_err AS min_lon, lon + lon_err AS max_lon
        FROM centred
    """


def _geohash_traffic_sql(minutes: int) -> str:
    return f"""
        SELECT {_text_sql(_z_sql(20), 20)} AS geohash, {_window_label(minutes)} AS timestamp,
               round(avg(speed), 9) AS avg_speed, count(*) AS vehicles
        FROM ({_xy_sql(20)}) GROUP BY 1, 2
    """


# All pairs of an event and a road piece.
MATCHED = f"""
    ev AS (SELECT * FROM ({EVENTS_SQL}) WHERE {INSIDE}),
    shapes AS (
        SELECT segment_id, x1, y1, (x2 - x1) * 0.7592713073e0 AS dx, y2 - y1 AS dy
        FROM ({ROADS_SQL})
    ),
    offsets AS (
        SELECT event_id, segment_id, dx, dy,
               (lon - x1) * 0.7592713073e0 AS px, lat - y1 AS py,
               CASE WHEN dx * dx + dy * dy = 0 THEN 1e0 ELSE dx * dx + dy * dy END AS len2
        FROM ev CROSS JOIN shapes
    ),
    feet AS (
        SELECT *, least(greatest((px * dx + py * dy) / len2, 0e0), 1e0) AS t FROM offsets
    ),
    pairs AS (
        SELECT event_id, segment_id,
               (px - t * dx) * (px - t * dx) + (py - t * dy) * (py - t * dy) AS d2
        FROM feet
    ),
    closest AS (
        SELECT event_id, min(d2) AS d2 FROM pairs WHERE d2 <= {MAX_DIST!r}e0 * {MAX_DIST!r}e0
        GROUP BY event_id
    ),
    matched AS (
        SELECT event_id, d2, min(segment_id) AS segment_id
        FROM pairs JOIN closest USING (event_id, d2) GROUP BY event_id, d2
    )
"""


def _road_sql(minutes: int, where: str = "TRUE") -> str:
    return f"""
        WITH {MATCHED}
        SELECT segment_id, strftime(max(timestamp), '%Y-%m-%d %H:%M:%S.%g') AS timestamp,
               round(avg(speed), 9) AS avg_speed, count(*) AS vehicles
        FROM matched JOIN ev USING (event_id)
        WHERE {where}
        GROUP BY segment_id, {_window_end(minutes)}
    """


# Covering cells with their coordinates.
COVERED = f"""
    points AS (SELECT device_id, {_z_sql(60)} AS z FROM ({_xy_sql(60)})),
    prefixes AS (
        SELECT device_id, 60 - cut AS p, min(z >> cut) AS z
        FROM points CROSS JOIN range(61) AS r(cut)
        GROUP BY device_id, cut HAVING count(DISTINCT z >> cut) = 1
    ),
    finest AS (SELECT device_id, max(p) AS p FROM prefixes GROUP BY 1),
    placed AS (
        SELECT device_id, p,
               z | CAST({1 << 62} AS BIGINT) | (CAST(1 AS BIGINT) << p) AS geohash_long,
               CAST(list_sum([((z >> (2 * i + 1 - p % 2)) & 1) << i FOR i IN range(31)]) AS BIGINT)
                   AS x,
               CAST(list_sum([((z >> (2 * i + p % 2)) & 1) << i FOR i IN range(31)]) AS BIGINT)
                   AS y
        FROM finest JOIN prefixes USING (device_id, p)
    )
"""
FILLED = f"""
    SELECT event_id, device_id, timestamp, coalesce(lon, 0e0) AS lon, coalesce(lat, 0e0) AS lat,
           coalesce(altitude, 0e0) AS altitude, coalesce(speed, 0e0) AS speed,
           coalesce(orientation, 0e0) AS orientation, coalesce(transfer, 0) AS transfer
    FROM ({RAW_SQL})
"""
PARSED = f"""device_id, {EVENT_TIME} AS timestamp, lon, lat, altitude, speed, orientation,
             transfer"""
TSV_REJECT = """
    CASE WHEN event_id % 23 = 0 THEN 'field count' WHEN event_id % 29 = 0 THEN 'device_id'
         WHEN event_id % 31 = 0 THEN 'timestamp' WHEN event_id % 37 = 0 THEN 'lon' END
"""
GPS = f"""
    SELECT device_id, {EVENT_TIME} AS inserted_timestamp, lon AS longitude, lat AS latitude,
           altitude, TRY_CAST(trunc(speed) AS INT) AS speed, orientation,
           {EVENT_TIME} AS recorded_timestamp, 1 AS valid, 20 AS zoneid, transfer,
           {EVENT_TIME} AS unix_timestamp
    FROM ({{}})
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return road_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return road_sql() | (llm.oracle_sql() if llm else {})


def road_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "grid_traffic_2min": grid_2min,
        "grid_traffic_1day": grid_1day,
        "grid_cells": grid_cells,
        "cell_centres": cell_centres,
        "grid_documents": grid_documents,
        "grid_folders": grid_folders,
        "grid_overwrite": grid_overwrite,
        "grid_folders_written": grid_folders_written,
        "documents_written": documents_written,
        "files_grid_traffic": files_grid_traffic,
        "bbox_flag": bbox_flag,
        "bbox_filter": bbox_filter,
        "fill_defaults": fill_defaults,
        "gps_columns": gps_columns,
        "tsv_lines": tsv_lines,
        "dedup_events": dedup_events,
        "geohash_points": geohash_points,
        "geohash_density": geohash_density,
        "geohash_long": geohash_long,
        "geohash_bounds": geohash_bounds,
        "geohash_text_bounds": geohash_text_bounds,
        "geohash_shifted": geohash_shifted,
        "geohash_neighbours": geohash_neighbours,
        "covering_geohash": covering_geohash,
        "geohash_rollup": geohash_rollup,
        "covering_bounds": covering_bounds,
        "covering_shifted": covering_shifted,
        "geohash_traffic": geohash_traffic,
        "geohash_traffic_1day": geohash_traffic_1day,
        "match_roads": match_roads,
        "match_roads_audit": match_roads_audit,
        "match_roads_shuffled": match_roads_shuffled,
        "match_roads_crowded": match_roads_crowded,
        "match_roads_crowded_shuffled": match_roads_crowded_shuffled,
        "road_traffic": road_traffic,
        "road_traffic_1day": road_traffic_1day,
        "road_topics": road_topics,
        "parse_tsv": parse_tsv,
        "tsv_rejects": tsv_rejects,
        "parse_json": parse_json,
        "parse_gps_csv": parse_gps_csv,
        "gps_events": gps_events,
        "tsv_split_written": tsv_split_written,
        "json_array_file": json_array_file,
        "archive_header_file": archive_header_file,
        "message_round_trip": message_round_trip,
        "stream_grid_traffic": stream_grid_traffic,
        "stream_road_traffic": stream_road_traffic,
        "stream_dedup": stream_dedup,
        "stream_neighbours": stream_neighbours,
        "stream_rollup": stream_rollup,
        "stream_documents": stream_documents,
        "late_events": late_events,
        "stream_quality": stream_quality,
        "segments_written": segments_written,
        "match_roads_hot": match_roads_hot,
        "neighbours_1day": neighbours_1day,
        "grid_windows_by_day": grid_windows_by_day,
    }


def road_sql() -> dict[str, str]:
    tab = "chr(9)"
    fields = ["device_id", EVENT_TIME, "lon", "lat", "altitude", "speed", "orientation", "transfer"]
    tsv = f" || {tab} || ".join(f"CAST({field} AS VARCHAR)" for field in fields)
    rollup = " UNION ALL ".join(
        f"SELECT {n} AS precision, substr(g, 1, {n}) AS geohash, count(*) AS records "
        "FROM points GROUP BY 1, 2"
        for n in (0, 4, 5, 6)
    )
    bbox = f"SELECT {COLUMNS} FROM ({EVENTS_SQL}) WHERE {INSIDE}"
    distinct = f"""
        SELECT {COLUMNS} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY device_id, epoch_ms(timestamp)
                ORDER BY event_id, timestamp, lon, lat, altitude, speed, orientation, transfer
            ) AS copy
            FROM ({COPIES_SQL})
        ) WHERE copy = 1"""
    matches = f"WITH {MATCHED} SELECT event_id, segment_id"
    points = f"""
        SELECT {_text_sql("z", 60)} AS g, label
        FROM (SELECT {_z_sql(60)} AS z, {_window_label(DAY)} AS label FROM ({_xy_sql(60)}))"""
    neighbours = f"""
        WITH cells AS (
            SELECT x, y, {_window_label(DAY)} AS label, count(*) AS records
            FROM ({_xy_sql(30)}) GROUP BY 1, 2, 3
        )
        SELECT {_text_sql(_z_sql(30, "a.x", "a.y"), 30)} AS geohash, a.label AS timestamp, a.records,
               CAST(sum(b.records) AS BIGINT) AS area_records
        FROM cells a JOIN cells b
            ON a.label = b.label AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1
        GROUP BY a.x, a.y, a.label, a.records"""
    crowded = f"{matches} FROM matched".replace(f"{MAX_DIST!r}e0", f"{CROWDED_DIST!r}e0")
    return {
        "grid_traffic_2min": _grid_sql(2),
        "grid_traffic_1day": _grid_sql(DAY),
        "grid_cells": f"WITH {LOCATED} SELECT event_id, cellid, in_bbox FROM located",
        "cell_centres": f"""WITH {LOCATED}
            SELECT cellid, {CENTRE} FROM (SELECT DISTINCT cellid FROM located)""",
        "grid_documents": f"""
            SELECT cellid, CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) AS location,
                   vehicles, timestamp, CAST(cellid AS VARCHAR) || '|' || timestamp AS doc_id
            FROM ({_grid_sql(DAY)})""",
        "grid_folders": f"""WITH {LOCATED}
            SELECT strftime(time_end, '%Y-%m-%d--%H%M') AS bucket,
                   '(' || cellid || ',' || count(*) || ','
                   || strftime(time_end, '%Y-%m-%d %H:%M:%S') || ')' AS line
            FROM (SELECT cellid, {_window_end(2)} AS time_end FROM located)
            GROUP BY cellid, time_end""",
        "grid_overwrite": _grid_sql(DAY),
        "grid_folders_written": f"""
            SELECT substr(timestamp, 1, 10) || '--' || substr(timestamp, 12, 2)
                   || substr(timestamp, 15, 2) AS bucket,
                   count(*) AS cells, CAST(sum(vehicles) AS BIGINT) AS vehicles
            FROM ({_grid_sql(DAY)}) GROUP BY 1""",
        "bbox_flag": f"SELECT event_id, {INSIDE} AS in_bbox FROM ({EVENTS_SQL})",
        "bbox_filter": bbox,
        "fill_defaults": f"SELECT {COLUMNS} FROM ({FILLED})",
        "gps_columns": GPS.format(EXTREMES_SQL),
        "tsv_lines": f"SELECT {tsv} AS value FROM ({EVENTS_SQL})",
        "dedup_events": distinct,
        "geohash_points": f"""
            SELECT a.event_id, {_text_sql(_z_sql(20, "a.x", "a.y"), 20)} AS geohash,
                   {_text_sql("b.z", 60)} AS geohash_60,
                   {_z_sql(33, "c.x", "c.y")} | {_tag_sql(33)} AS geohash_long
            FROM ({_xy_sql(20)}) a
            JOIN (SELECT event_id, {_z_sql(60)} AS z FROM ({_xy_sql(60)})) b USING (event_id)
            JOIN ({_xy_sql(33)}) c USING (event_id)""",
        "geohash_density": f"""
            SELECT {_text_sql(_z_sql(30), 30)} AS geohash, records FROM ({_cells_sql(30)})""",
        "geohash_long": f"""
            SELECT {_z_sql(33)} | {_tag_sql(33)} AS geohash_long, records
            FROM ({_cells_sql(33)})""",
        "geohash_bounds": _bounds_sql(33, "geohash_long", f"{_z_sql(33)} | {_tag_sql(33)}"),
        "geohash_text_bounds": _bounds_sql(30, "geohash", _text_sql(_z_sql(30), 30)),
        "geohash_shifted": f"""
            SELECT {_z_sql(33, "(x + 3)", "(y - 2)")} | {_tag_sql(33)} AS geohash_long, records
            FROM ({_cells_sql(33)})""",
        "geohash_neighbours": f"""
            WITH cells AS ({_cells_sql(30)})
            SELECT {_text_sql(_z_sql(30, "a.x", "a.y"), 30)} AS geohash, a.records,
                   CAST(sum(b.records) AS BIGINT) AS area_records
            FROM cells a JOIN cells b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1
            GROUP BY a.x, a.y, a.records""",
        "covering_geohash": f"""
            WITH points AS (SELECT device_id, {_z_sql(60)} AS z FROM ({_xy_sql(60)})),
            prefixes AS (
                SELECT device_id, CAST(cut AS INT) AS cut, min(z >> cut) AS z
                FROM points CROSS JOIN range(61) AS r(cut)
                GROUP BY device_id, cut HAVING count(DISTINCT z >> cut) = 1
            ),
            finest AS (SELECT device_id, min(cut) AS cut FROM prefixes GROUP BY 1)
            SELECT device_id, cut AS reduction, 60 - cut AS precision,
                   z | (CAST({1 << 62} AS BIGINT)) | (CAST(1 AS BIGINT) << (60 - cut))
                       AS geohash_long,
                   substr({_text_sql("(z << cut)", 60)}, 1, (60 - cut) // 5) AS geohash
            FROM finest JOIN prefixes USING (device_id, cut)""",
        "geohash_rollup": f"""
            WITH points AS (
                SELECT {_text_sql("z", 60)} AS g
                FROM (SELECT {_z_sql(60)} AS z FROM ({_xy_sql(60)}))
            ) {rollup}""",
        "geohash_traffic": _geohash_traffic_sql(2),
        "geohash_traffic_1day": _geohash_traffic_sql(DAY),
        "match_roads": f"{matches}, round(sqrt(d2), 12) AS distance FROM matched",
        "match_roads_audit": f"""
            WITH {MATCHED} SELECT e.event_id, segment_id
            FROM ({EVENTS_SQL}) e LEFT JOIN matched USING (event_id)""",
        "match_roads_shuffled": f"{matches} FROM matched",
        "match_roads_crowded": crowded,
        "match_roads_crowded_shuffled": crowded,
        "road_traffic": _road_sql(2),
        "road_traffic_1day": _road_sql(DAY),
        "road_topics": f"""
            SELECT 'road-' || segment_id AS topic, segment_id AS key, count(*) AS messages
            FROM ({_road_sql(DAY)}) GROUP BY segment_id""",
        "parse_tsv": f"SELECT {PARSED} FROM ({FILLED}) WHERE ({TSV_REJECT}) IS NULL",
        "tsv_rejects": f"""
            SELECT {TSV_REJECT} AS reject, count(*) AS records FROM ({FILLED}) GROUP BY 1""",
        "parse_json": f"""
            SELECT {PARSED.replace("speed", "trunc(speed) AS speed")}
            FROM ({FILLED}) WHERE event_id % 19 <> 0""",
        "parse_gps_csv": GPS.format(EVENTS_SQL),
        "gps_events": f"SELECT {PARSED.replace('speed', 'trunc(speed) AS speed')} FROM ({EVENTS_SQL})",
        "archive_header_file": """
            SELECT NULL AS reject, count(*) AS records FROM events
            UNION ALL SELECT 'field count', 2""",
        "tsv_split_written": f"""
            SELECT {TSV_REJECT} AS reject, count(*) AS records FROM ({FILLED}) GROUP BY 1""",
        "json_array_file": f"""
            SELECT {PARSED.replace("speed", "trunc(speed) AS speed")}, NULL AS reject
            FROM ({FILLED}) WHERE event_id % 19 <> 0 AND event_id <>
                (SELECT max(event_id) FROM events WHERE event_id % 8 = 0)
            UNION ALL SELECT {", ".join(["NULL"] * 8)}, 'array'""",
        "files_grid_traffic": f"""
            SELECT '(' || concat_ws(',', cellid, lat, lon, vehicles, timestamp) || ')' AS line
            FROM ({_grid_sql(2)})""",
        "documents_written": f"""
            SELECT cellid, CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) AS location,
                   vehicles, timestamp, CAST(cellid AS VARCHAR) || '|' || timestamp AS doc_id
            FROM ({_grid_sql(DAY)})""",
        "covering_bounds": f"""
            WITH {COVERED}, errors AS (
                SELECT *, 90e0 / CAST(CAST(1 AS BIGINT) << (p // 2) AS DOUBLE) AS lat_err,
                       180e0 / CAST(CAST(1 AS BIGINT) << ((p + 1) // 2) AS DOUBLE) AS lon_err
                FROM placed
            ), centred AS (
                SELECT device_id, geohash_long, lat_err, lon_err,
                       y / CAST(CAST(1 AS BIGINT) << (p // 2) AS DOUBLE) * 180e0 - 90e0 + lat_err
                           AS lat,
                       x / CAST(CAST(1 AS BIGINT) << ((p + 1) // 2) AS DOUBLE) * 360e0 - 180e0
                           + lon_err AS lon
                FROM errors
            )
            SELECT *, lat - lat_err AS min_lat, lat + lat_err AS max_lat,
                   lon - lon_err AS min_lon, lon + lon_err AS max_lon
            FROM centred""",
        "covering_shifted": f"""
            WITH {COVERED}, moved AS (
                SELECT device_id, p,
                       (x + (CAST(1 AS BIGINT) << ((p + 1) // 2)) - 2)
                           % (CAST(1 AS BIGINT) << ((p + 1) // 2)) AS x,
                       (y + 3) % (CAST(1 AS BIGINT) << (p // 2)) AS y
                FROM placed
            ), numbered AS (
                SELECT device_id, p, CASE WHEN p % 2 = 0 THEN {_z_sql(60)}
                       ELSE {_z_sql(61)} END AS plain
                FROM moved
            )
            SELECT device_id, plain, CAST(p AS INT) AS precision,
                   plain | CAST({1 << 62} AS BIGINT) | (CAST(1 AS BIGINT) << p) AS geohash_long
            FROM numbered""",
        "message_round_trip": f"SELECT {PARSED} FROM ({EVENTS_SQL})",
        "stream_grid_traffic": _grid_sql(2),
        "stream_road_traffic": _road_sql(DAY),
        "stream_dedup": f"""
            SELECT {PARSED} FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY device_id, epoch_ms(timestamp)
                    ORDER BY timestamp, lon, lat, altitude, speed, orientation, transfer
                ) AS copy
                FROM ({COPIES_SQL})
            ) WHERE copy = 1""",
        "stream_neighbours": neighbours,
        "neighbours_1day": neighbours,
        "stream_rollup": " UNION ALL ".join(
            f"SELECT {n} AS precision, substr(g, 1, {n}) AS geohash, label AS timestamp, "
            f"count(*) AS records FROM ({points}) GROUP BY 2, 3"
            for n in (0, 4, 5, 6)
        ),
        "stream_documents": f"""
            SELECT cellid, CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) AS location,
                   vehicles, timestamp, CAST(cellid AS VARCHAR) || '|' || timestamp AS doc_id
            FROM ({_grid_sql(DAY)})""",
        "stream_quality": f"""
            SELECT {TSV_REJECT} AS reject, count(*) AS records FROM ({FILLED}) GROUP BY 1""",
        "segments_written": f"""
            SELECT segment_id, count(*) AS windows, CAST(sum(vehicles) AS BIGINT) AS vehicles
            FROM ({_road_sql(DAY)}) GROUP BY 1""",
        "match_roads_hot": f"{matches} FROM matched".replace(EVENTS_SQL, HOT_SQL),
        "late_events": f"""
            WITH ends AS (
                SELECT min(epoch_us(timestamp)) AS a, max(epoch_us(timestamp)) AS b FROM ({EVENTS_SQL})
            ), parts AS (
                SELECT e.*, least(2, (epoch_us(timestamp) - a) // ((b - a) // 3 + 1)
                                     + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END) AS part
                FROM ({EVENTS_SQL}) e, ends
            ), marks AS (
                SELECT p.part, max(epoch_us(q.timestamp)) - 60000000 AS mark
                FROM (SELECT DISTINCT part FROM parts) p LEFT JOIN parts q ON q.part < p.part
                GROUP BY p.part
            )
            SELECT {PARSED}, CASE WHEN epoch_us({_window_end(2)}) <= mark THEN 'late'
                                  ELSE 'on-time' END AS kind
            FROM parts JOIN marks USING (part)""",
        "grid_windows_by_day": f"""
            SELECT substr(timestamp, 1, 10) AS day, substr(timestamp, 1, 10) || '--'
                   || substr(timestamp, 12, 2) || substr(timestamp, 15, 2) AS bucket,
                   count(*) AS cells, CAST(sum(vehicles) AS BIGINT) AS vehicles
            FROM ({_grid_sql(2)}) GROUP BY 1, 2""",
    }
