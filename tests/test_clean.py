from datetime import datetime

from pyspark.sql import Observation

from roadpulse.operators import clean
from roadpulse.schema import EVENT_SCHEMA, GPS_SCHEMA
from roadpulse.sources.records import parse_tsv


def test_defaults(spark):
    rows = [(1, datetime(2017, 1, 1), None, None, None, None, None, None)]
    filled = clean.fill_defaults(spark.createDataFrame(rows, EVENT_SCHEMA)).first()
    assert tuple(filled)[2:] == (0.0, 0.0, 0.0, 0.0, 0.0, 0)


def test_archive_layout(spark, events):
    out = clean.to_gps_columns(events([(7, "2017-01-01 00:00:01.5", 22.9, 40.6, 35.9)]))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in GPS_SCHEMA]
    row = out.first()
    assert (row.speed, row.valid, row.zoneid) == (35, 1, 20)
    assert row.inserted_timestamp == row.unix_timestamp == "2017-01-01 00:00:01.500"


def test_archive_speed_out_of_range(spark, events):
    speeds = [1e10, float("nan"), float("inf"), -35.9]
    rows = [(i, "2017-01-01 00:00:01.5", 22.9, 40.6, speed) for i, speed in enumerate(speeds)]
    out = clean.to_gps_columns(events(rows)).orderBy("device_id").collect()
    assert [row.speed for row in out] == [None, None, None, -35]


def test_split_is_stored_in_one_pass(spark, tmp_path):
    lines = spark.createDataFrame(
        [("a\tb",), ("1\t2017-01-01 00:00:00.0\t\t\t\t\t\t",)], "value string"
    )
    for _ in range(2):
        good, bad = clean.store_split(parse_tsv(lines), str(tmp_path / "split"))
    assert good.schema.simpleString() == EVENT_SCHEMA.simpleString()
    assert good.count() == 1 and [tuple(row) for row in bad.collect()] == [("a\tb", "field count")]


def test_line_and_back(spark, events):
    original = events([(84037, "2017-01-01 00:00:01.5", 22.948426, 40.626444, 35.5)])
    lines = clean.to_tsv_line(original)
    assert lines.first().value == (
        "84037\t2017-01-01 00:00:01.500\t22.948426\t40.626444\t0.0\t35.5\t0.0\t0"
    )
    assert clean.split_valid(parse_tsv(lines))[0].collect() == original.collect()


def test_same_millisecond_is_the_same_event(spark, events):
    rows = [
        (1, "2017-01-01 00:00:01.5001", 22.9, 40.6, 1.0),
        (1, "2017-01-01 00:00:01.5009", 22.9, 40.6, 1.0),
        (1, "2017-01-01 00:00:01.501", 22.9, 40.6, 1.0),
        (2, "2017-01-01 00:00:01.500", 22.9, 40.6, 1.0),
    ]
    assert clean.dedup_events(events(rows * 3)).count() == 3


def test_dedup_merges_copies_before_the_shuffle(events):
    df = clean.dedup_events(events([(1, "2017-01-01 00:00:01", 22.9, 40.6, 1.0)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") == 2 and plan.count("Exchange") == 1
    assert "partial_min" in plan


def test_dedup_keeps_the_smallest_copy(spark, events):
    rows = [(1, "2017-01-01 00:00:01.5", 22.9, 40.6, float(speed)) for speed in (3, 1, 2)]
    for order in (rows, rows[::-1]):
        assert [row.speed for row in clean.dedup_events(events(order)).collect()] == [1.0]


def test_unidentified(spark):
    df = spark.createDataFrame([("1",), ("",), (None,), (" ",)], "device_random_id string")
    assert clean.drop_unidentified(df).count() == 1


def test_quality_counts_in_the_same_pass(spark):
    lines = spark.createDataFrame([("a\tb",), ("1\t2017-01-01 00:00:00.0\t\t\t\t\t\t",)], "value string")
    seen = Observation("quality")
    clean.observe_quality(parse_tsv(lines), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"good": 1, "rejected": 1}
    counts = {r.reject: r.records for r in clean.reject_counts(parse_tsv(lines)).collect()}
    assert counts == {None: 1, "field count": 1}
