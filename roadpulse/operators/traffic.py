"""Event-time window reports. One partial-aggregated shuffle each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geohash as gh
from roadpulse.functions import grid as grid_fn
from roadpulse.functions.text import print_event_time, print_window_time
from roadpulse.schema import GRID, Grid

def _window(minutes: int) -> Column:
    return F.window("timestamp", f"{minutes} minutes")


def grid_traffic(events: DataFrame, minutes: int, grid: Grid = GRID) -> DataFrame:
    """Records per grid cell and tumbling window: ``cellid, lat, lon, vehicles, timestamp``.

    ``timestamp`` is the end of the window as text. An event is reduced to its cell
    before the shuffle; centre and label are added to the aggregated rows.
    """
    cells = events.select(
        "timestamp", grid_fn.cell_id(F.col("lon"), F.col("lat"), grid).alias("cellid")
    )
    counts = cells.groupBy("cellid", _window(minutes)).agg(F.count(F.lit(1)).alias("vehicles"))
    return counts.select(
        "cellid",
        grid_fn.centre_lat(F.col("cellid"), grid).alias("lat"),
        grid_fn.centre_lon(F.col("cellid"), grid).alias("lon"),
        "vehicles",
        print_window_time(F.col("window.end")).alias("timestamp"),
    )


def road_traffic(matched: DataFrame, minutes: int = 2) -> DataFrame:
    """Flow and mean speed per road segment and window:
    ``segment_id, timestamp, avg_speed, vehicles``; ``timestamp`` is that of the latest
    record."""
    measures = matched.select("segment_id", "timestamp", "speed")
    report = measures.groupBy("segment_id", _window(minutes)).agg(
        F.max("timestamp").alias("latest"),
        F.avg("speed").alias("avg_speed"),
        F.count(F.lit(1)).alias("vehicles"),
    )
    return report.select(
        "segment_id", print_event_time(F.col("latest")).alias("timestamp"), "avg_speed", "vehicles"
    )


def geohash_traffic(events: DataFrame, bits: int = 20, minutes: int = 2) -> DataFrame:
    """Records and mean speed per geohash cell and window:
    ``geohash, timestamp, avg_speed, vehicles``; ``timestamp`` is the end of the window."""
    gh.check_bits(bits, text=True)
    cells = events.select(
        "timestamp",
        "speed",
        gh.cell_x(F.col("lon"), bits).alias("_x"),
        gh.cell_y(F.col("lat"), bits).alias("_y"),
    )
    report = cells.groupBy("_x", "_y", _window(minutes)).agg(
        F.avg("speed").alias("avg_speed"), F.count(F.lit(1)).alias("vehicles")
    )
    return report.select(
        gh.text(gh.interleave(F.col("_x"), F.col("_y"), bits), bits).alias("geohash"),
        print_window_time(F.col("window.end")).alias("timestamp"),
        "avg_speed",
        "vehicles",
    )
