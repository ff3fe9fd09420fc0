"""Record layouts and the study area."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values up to EVENT_AVRO: layouts of stored data and messages.

# One GPS record of one vehicle. Column order is also the order of the text format.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("altitude", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("orientation", T.DoubleType()),
        T.StructField("transfer", T.IntegerType()),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

# Measures that are optional in the input, with the value of a missing one.
DEFAULTS = {
    "lon": 0.0,
    "lat": 0.0,
    "altitude": 0.0,
    "speed": 0.0,
    "orientation": 0.0,
    "transfer": 0,
}

# JSON records, all as text: an unidentified vehicle sends the id "", and a value that
# is no number has to be seen to be rejected.
JSON_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "device_random_id",
            "recorded_timestamp",
            "lon",
            "lat",
            "altitude",
            "speed",
            "orientation",
            "transfer",
        )
    ]
)

# The 12-column archive layout (comma-separated).
GPS_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.IntegerType()),
        T.StructField("inserted_timestamp", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("altitude", T.DoubleType()),
        T.StructField("speed", T.IntegerType()),
        T.StructField("orientation", T.DoubleType()),
        T.StructField("recorded_timestamp", T.StringType()),
        T.StructField("valid", T.IntegerType()),
        T.StructField("zoneid", T.IntegerType()),
        T.StructField("transfer", T.IntegerType()),
        T.StructField("unix_timestamp", T.StringType()),
    ]
)

# Static road table: straight pieces, x = longitude and y = latitude in degrees.
ROAD_SCHEMA = T.StructType(
    [
        T.StructField("segment_id", T.StringType()),
        T.StructField("x1", T.DoubleType()),
        T.StructField("y1", T.DoubleType()),
        T.StructField("x2", T.DoubleType()),
        T.StructField("y2", T.DoubleType()),
    ]
)

# Message layout on the event topic; the timestamp travels as text.
EVENT_AVRO = """{
  "type": "record",
  "name": "FcdEvent",
  "fields": [
    {"name": "device_id", "type": "int"},
    {"name": "timestamp", "type": "string"},
    {"name": "lon", "type": "double"},
    {"name": "lat", "type": "double"},
    {"name": "altitude", "type": "double"},
    {"name": "speed", "type": "double"},
    {"name": "orientation", "type": "double"},
    {"name": "transfer", "type": "int"}
  ]
}"""

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
WINDOW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Box:
    """An area in degrees; a point on its border is outside."""

    west: float
    east: float
    south: float
    north: float


@dataclass(frozen=True)
class Grid:
    """A box cut into ``rows`` x ``cols`` cells, numbered from 1 at the north-west."""

    box: Box
    rows: int
    cols: int

    @property
    def row_height(self) -> float:
        return (self.box.north - self.box.south) / self.rows

    @property
    def col_width(self) -> float:
        return (self.box.east - self.box.west) / self.cols


# The area of Thessaloniki and its 100 x 100 grid.
BOX = Box(west=22.80, east=23.05, south=40.50, north=40.70)
GRID = Grid(BOX, rows=100, cols=100)
