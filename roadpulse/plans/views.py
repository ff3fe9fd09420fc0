"""Vehicle events and roads derived from the test tables, which hold no coordinates.

The SQL texts run in Spark and DuckDB alike. Literals have exponents: ``1e5`` is a
double in both, ``1.5`` would be a decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import use_utc

EVENTS_SQL = """
    SELECT event_id, CAST(user_id AS INT) AS device_id, ts AS timestamp,
           22.78e0 + ((event_id * 7919) % 29000) / 1e5 AS lon,
           40.48e0 + ((event_id * 104729) % 24000) / 1e5 AS lat,
           CAST(event_id % 500 AS DOUBLE) / 1e1 AS altitude,
           value AS speed,
           CAST((event_id * 37) % 360 AS DOUBLE) AS orientation,
           CAST(event_id % 2 AS INT) AS transfer
    FROM events
"""

# Gaps in the measures.
GAPS = {"lon": 11, "lat": 13, "altitude": 7, "speed": 5, "orientation": 17, "transfer": 3}
RAW_SQL = "SELECT event_id, device_id, timestamp, {} FROM ({})".format(
    ", ".join(
        f"CASE WHEN event_id % {k} = 0 THEN NULL ELSE {name} END AS {name}"
        for name, k in GAPS.items()
    ),
    EVENTS_SQL,
)

# Copies of every seventh event, every other one with another speed.
COPIES_SQL = f"""
    SELECT * FROM ({EVENTS_SQL}) UNION ALL
    SELECT event_id, device_id, timestamp, lon, lat, altitude,
           speed + CAST(event_id % 2 AS DOUBLE) AS speed, orientation, transfer
    FROM ({EVENTS_SQL}) WHERE event_id % 7 = 0
"""

# Every third event within a few metres of the end of a road piece.
HOT_SQL = f"""
    SELECT event_id, device_id, timestamp,
           CASE WHEN event_id % 3 = 0 THEN 22.86907e0 + (event_id % 11) / 1e6 ELSE lon END AS lon,
           CASE WHEN event_id % 3 = 0 THEN 40.55151e0 + (event_id % 7) / 1e6 ELSE lat END AS lat,
           altitude, speed, orientation, transfer
    FROM ({EVENTS_SQL})
"""

# Speeds that the archive layout cannot hold, and negative ones.
EXTREMES_SQL = f"""
    SELECT event_id, device_id, timestamp, lon, lat, altitude,
           CASE WHEN event_id % 41 = 0 THEN 1e10 WHEN event_id % 43 = 0
                THEN CAST('NaN' AS DOUBLE) WHEN event_id % 5 = 0 THEN -speed ELSE speed END
               AS speed,
           orientation, transfer
    FROM ({EVENTS_SQL})
"""

# One straight road piece per customer, up to 400 m long; every fifth lies on the same place.
ROADS_SQL = """
    SELECT segment_id, x1, y1,
           x1 + ((k * 389) % 1000 - 500) / 1e5 AS x2,
           y1 + ((k * 631) % 800 - 400) / 1e5 AS y2
    FROM (
        SELECT segment_id, k,
               22.79e0 + ((k * 7907) % 27000) / 1e5 AS x1,
               40.49e0 + ((k * 6151) % 22000) / 1e5 AS y1
        FROM (
            SELECT concat('r', CAST(c_custkey AS VARCHAR(20))) AS segment_id,
                   CASE WHEN c_custkey % 5 = 0 THEN 5 ELSE c_custkey END AS k
            FROM customer
        )
    )
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    derived = spark.sql(
        query.replace("FROM events", "FROM {source}"), source=table(spark, sf_dir, "events")
    )
    return derived.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def fcd_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, EVENTS_SQL)


def fcd_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, RAW_SQL)


def fcd_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, COPIES_SQL)


def fcd_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, HOT_SQL)


def fcd_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, EXTREMES_SQL)


def fcd_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        ROADS_SQL.replace("FROM customer", "FROM {source}"),
        source=table(spark, sf_dir, "customer"),
    )
