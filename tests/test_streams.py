import shutil

import pytest
from fcd_lines import tsv
from test_roads import SCHEMA, lattice

from roadpulse.operators.clean import (
    REASONS,
    dedup_events,
    observe_quality,
    reject_counts,
    split_valid,
    store_split,
    stored_good,
)
from roadpulse.operators.geohash import geohash_neighbour_density, geohash_rollup_windows
from roadpulse.operators.roads import build_road_index, match_roads
from roadpulse.operators.traffic import grid_traffic
from roadpulse.plans import jobs
from roadpulse.sources.files import parsed_fcd_tsv, read_fcd_tsv, stream_fcd
from roadpulse.sources.records import parse_tsv
from roadpulse.schema import EVENT_SCHEMA
from roadpulse.streaming.quality import QualityLedger, quality_totals, read_quality
from roadpulse.streaming.event_time import (
    late_rows,
    split_late,
    store_by_lateness,
    stored_events,
    with_fcd_watermark,
)

DAY = "2017-01-01 "


def at(*times, **kw):
    return [tsv(1 + i, f"{DAY}{t}.000", **kw) for i, t in enumerate(times)]


def run(spark, report, out, state, file_format="json"):
    writer = report.writeStream.format(file_format).outputMode("append").option("path", str(out))
    query = writer.option("checkpointLocation", str(state)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def counts(spark, out):
    rows = spark.read.schema("timestamp string, vehicles int, cellid int").json(str(out)).collect()
    return {(r.cellid, r.timestamp[11:]): r.vehicles for r in rows}


def test_late_records(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    batches = {
        "a": at("00:00:10", "00:01:00"),
        "b": at("00:02:50", "00:03:10"),
        "b2": at("00:03:20"),
        "c": at("00:01:30", "00:02:10"),
        "z": at("01:00:00"),
    }
    for order, (name, lines) in enumerate(batches.items()):
        drop_file(source, name, lines, order)
    events = jobs.file_events(spark, str(source), 1)
    query = run(spark, jobs.grid_report(events, 2), tmp_path / "out", tmp_path / "state")
    assert counts(spark, tmp_path / "out") == {(3660, "00:02:00"): 2, (3660, "00:04:00"): 4}
    assert late_rows(query) == 1


def test_disorder_within_the_delay_is_counted(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    drop_file(source, "a", at("00:02:30", "00:01:31"), 0)
    drop_file(source, "b", at("00:02:40", "00:01:50"), 1)
    drop_file(source, "z", at("01:00:00"), 2)
    events = jobs.file_events(spark, str(source), 1)
    query = run(spark, jobs.grid_report(events, 2), tmp_path / "out", tmp_path / "state")
    assert counts(spark, tmp_path / "out") == {(3660, "00:02:00"): 2, (3660, "00:04:00"): 2}
    assert late_rows(query) == 0


def test_stream_in_parts_and_restarted_is_the_batch(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    lines = [
        tsv(i, f"{DAY}00:{i // 60:02d}:{i % 60:02d}.000", 22.78 + i * 7 % 290 / 1e3, 40.6)
        for i in range(600)
    ]
    lines.insert(100, "broken")
    for part in range(3):
        drop_file(source, f"p{part}", lines[part * 201 : (part + 1) * 201], part)
    report = jobs.grid_report(jobs.file_events(spark, str(source), 1), 2)
    run(spark, report, tmp_path / "out", tmp_path / "state")
    seen = counts(spark, tmp_path / "out")
    drop_file(source, "tick", at("05:00:00"), 10)
    report = jobs.grid_report(jobs.file_events(spark, str(source), 1), 2)
    run(spark, report, tmp_path / "out", tmp_path / "state")
    good, bad = read_fcd_tsv(spark, str(source))
    batch = {
        (r.cellid, r.timestamp[11:]): r.vehicles
        for r in grid_traffic(good, 2).collect()
        if r.timestamp[11:] < "05"
    }
    assert counts(spark, tmp_path / "out") == batch
    assert set(seen) < set(batch)
    assert sum(batch.values()) == 600 and bad.count() == 1


def test_map_match_stream_is_the_batch(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    lines = [
        tsv(i, f"{DAY}00:{i // 60:02d}:{i % 60:02d}.000", 22.8 + i / 4e3, 40.5403 + i / 1e6, i / 7)
        for i in range(400)
    ]
    drop_file(source, "a", lines[:200], 0)
    drop_file(source, "b", lines[200:], 1)
    drop_file(source, "tick", at("05:00:00", lon=22.9, lat=40.54), 2)
    roads = spark.createDataFrame(lattice(), SCHEMA)
    batch = jobs.road_report(read_fcd_tsv(spark, str(source))[0], roads)
    expected = sorted(r for r in map(tuple, batch.collect()) if r[1] < f"{DAY}05")
    assert len(expected) > 10

    index = build_road_index(roads, 0.001)
    events = jobs.file_events(spark, str(source), 1)
    run(spark, jobs.road_report(events, index), tmp_path / "out", tmp_path / "state", "parquet")
    got = spark.read.parquet(str(tmp_path / "out")).select(*batch.columns)
    assert sorted(map(tuple, got.collect())) == expected

    # The jobs themselves, into one folder per segment: the stream, and the finite folder
    # with the window that the stream has left open.
    events = jobs.file_events(spark, str(source), 1)
    query = jobs.stream_map_match(
        spark, events, index, sink=str(tmp_path / "s"), checkpoint=str(tmp_path / "state2"), trigger=jobs.DRAIN
    )
    query.awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "s")).select(*batch.columns)
    assert sorted(map(tuple, stored.collect())) == expected
    assert (tmp_path / "s" / f"segment_id={expected[0][0]}").is_dir()
    roads.write.parquet(str(tmp_path / "roads"))
    for _ in range(2):
        rejected = jobs.map_match(spark, str(source), str(tmp_path / "roads"), sink=str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b")).select(*batch.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))
    assert rejected.count() == 0


def test_dedup_across_batches(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    drop_file(source, "a", at("00:00:10", "00:01:00") * 3, 0)
    drop_file(source, "b", at("00:00:10", "00:01:01"), 1)
    events, _ = split_valid(stream_fcd(spark, str(source), 1))
    first = dedup_events(with_fcd_watermark(events), keep="first")
    run(spark, first, tmp_path / "out", tmp_path / "state")
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    with pytest.raises(ValueError):
        dedup_events(events, keep="last")


def test_smallest_copy_across_batches_is_that_of_the_batch(spark, tmp_path, drop_file):
    """A later batch brings a smaller copy; copies out of order are merged within the delay."""
    source = tmp_path / "in"
    source.mkdir()
    drop_file(source, "a", [*at("00:00:10", speed=9.0), *at("00:00:40", speed=5.0)], 0)
    drop_file(source, "b", [*at("00:00:10", speed=3.0), *at("00:00:40", speed=7.0)], 1)
    drop_file(source, "c", [*at("00:00:10", speed=4.0), *at("00:00:10", lon=22.9, speed=8.0)], 2)
    drop_file(source, "tick", at("05:00:00"), 3)
    events = jobs.file_events(spark, str(source), 1)
    stream = dedup_events(with_fcd_watermark(events))
    run(spark, stream, tmp_path / "out", tmp_path / "state", "parquet")
    got = spark.read.parquet(str(tmp_path / "out")).select(*stream.columns)
    batch = dedup_events(read_fcd_tsv(spark, str(source))[0])
    want = [r for r in map(tuple, batch.collect()) if r[1].hour < 5]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == 2
    assert {(r.lon, r.speed) for r in got.collect()} == {(22.9, 8.0), (22.948426, 5.0)}


def test_late_events_are_stored_and_replayed(spark, tmp_path, drop_file):
    source, path = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    drop_file(source, "a", at("00:00:10", "00:03:30"), 0)
    drop_file(source, "b", at("00:01:50", "00:02:30", "00:10:00"), 1)
    drop_file(source, "c", at("00:03:59", "00:09:10", "00:07:59"), 2)
    stream = jobs.file_events(spark, str(source), 1)
    split_late(stream, path, str(tmp_path / "state"), 2, trigger=jobs.DRAIN).awaitTermination()

    def stored():
        rows = stored_events(spark, path, EVENT_SCHEMA).collect()
        return sorted((r.timestamp.strftime("%M:%S"), r.kind) for r in rows)

    # After the first batch windows up to 00:02 are closed, after the second up to 00:08.
    want = [("00:10", "on-time"), ("01:50", "late"), ("02:30", "on-time"), ("03:30", "on-time"),
            ("03:59", "late"), ("07:59", "late"), ("09:10", "on-time"), ("10:00", "on-time")]
    assert stored() == want
    # A replayed batch is judged by the batches before it, and replaces its rows.
    lines = spark.read.text(str(source / "b"))
    store_by_lateness(split_valid(parse_tsv(lines))[0], 1, path, 2)
    assert stored() == want
    # Rows of a batch that was not entered are not read.
    shutil.rmtree(f"{path}-ledger/entry=2")
    assert len(stored()) == 5


def test_chained_windows_of_a_stream_are_those_of_the_batch(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    lines = [tsv(i, f"{DAY}00:{i // 30:02d}:{2 * i % 60:02d}.000", 22.8 + i % 7 / 1e3, 40.5 + i % 5 / 1e3) for i in range(300)]
    for part in range(3):
        drop_file(source, f"p{part}", lines[part * 100 : part * 100 + 100], part)
    drop_file(source, "tick", at("05:00:00"), 4)
    for number, job in enumerate((
        lambda rows: geohash_neighbour_density(rows, 30, 2),
        lambda rows: geohash_rollup_windows(rows, 2, 3, 6),
    )):
        stream = job(with_fcd_watermark(jobs.file_events(spark, str(source), 1)))
        run(spark, stream, tmp_path / f"out{number}", tmp_path / f"state{number}", "parquet")
        got = spark.read.parquet(str(tmp_path / f"out{number}")).select(*stream.columns)
        batch = job(read_fcd_tsv(spark, str(source))[0]).where("timestamp < '2017-01-01 05'")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
        assert got.select("timestamp").distinct().count() == 5


def test_rejected_lines_of_a_stream(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    drop_file(source, "a", ["1\t2", *at("00:00:10"), "x"], 0)
    _, bad = split_valid(stream_fcd(spark, str(source)))
    run(spark, bad, tmp_path / "out", tmp_path / "state")
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_stream_stores_good_and_rejected_in_one_pass(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    drop_file(source, "a", ["1\t2", *at("00:00:10", "00:01:00"), "x"], 0)
    path = str(tmp_path / "parsed")
    with pytest.raises(ValueError):
        store_split(stream_fcd(spark, str(source)), path)
    store_split(
        stream_fcd(spark, str(source)), path, str(tmp_path / "state"), jobs.DRAIN
    ).awaitTermination()
    stored = spark.read.parquet(path)
    assert {r.outcome: r["count"] for r in stored.groupBy("outcome").count().collect()} == {
        "good": 2,
        "rejected": 2,
    }
    events = stream_fcd(spark, stored_good(path), file_format="parquet")
    run(spark, events, tmp_path / "out", tmp_path / "state2")
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_parquet_stream(spark, tmp_path):
    folder = tmp_path / "in"
    lines = spark.createDataFrame([(line,) for line in at("00:00:10", "00:01:00")], "value string")
    split_valid(parse_tsv(lines))[0].write.parquet(str(folder))
    events = stream_fcd(spark, str(folder), file_format="parquet")
    run(spark, events, tmp_path / "out", tmp_path / "state")
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_events_outside_the_box_advance_event_time(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    lines = [tsv(i, f"{DAY}00:00:{i:02d}.000", 22.8 + i / 4e2, 40.5403) for i in range(60)]
    drop_file(source, "a", lines, 0)
    drop_file(source, "tick", at("05:00:00", lon=22.78, lat=40.48), 1)
    roads = spark.createDataFrame(lattice(), SCHEMA)
    index = build_road_index(roads, 0.001)
    report = jobs.road_report(jobs.file_events(spark, str(source), 1), index)
    run(spark, report, tmp_path / "out", tmp_path / "state", "parquet")
    got = spark.read.parquet(str(tmp_path / "out")).select(*report.columns)
    batch = jobs.road_report(read_fcd_tsv(spark, str(source))[0], roads)
    expected = sorted(map(tuple, batch.collect()))
    assert expected and sorted(map(tuple, got.collect())) == expected


def below_watermark(rows):
    plan = rows._jdf.queryExecution()
    optimizer = plan.sparkSession().sessionState().optimizer()
    text = optimizer.execute(plan.analyzed()).toString()
    return text.split("EventTimeWatermark", 1)[1].split("StreamingRelation", 1)[0]


def test_no_predicate_passes_the_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    lines = spark.createDataFrame([(line,) for line in at("00:00:10")], "value string")
    split_valid(parse_tsv(lines))[0].write.parquet(str(folder))
    index = build_road_index(spark.createDataFrame(lattice(), SCHEMA), 0.001)
    report = jobs.road_report(stream_fcd(spark, str(folder), file_format="parquet"), index)
    assert "Filter" not in below_watermark(report)
    # Without the barrier the box would be tested below it.
    loose = stream_fcd(spark, str(folder), file_format="parquet").withWatermark("timestamp", "1 minute")
    assert "Filter" in below_watermark(match_roads(loose, index))


def test_quality_of_each_batch(spark, tmp_path, drop_file):
    source, path = tmp_path / "in", str(tmp_path / "quality")
    source.mkdir()
    drop_file(source, "a", ["1\t2", *at("00:00:10", "00:01:00"), "x", tsv("z", f"{DAY}00:00:01.000")], 0)
    drop_file(source, "b", at("00:02:00"), 1)
    drop_file(source, "c", ["bad"], 2)
    ledger = QualityLedger(spark, path)
    spark.streams.addListener(ledger)
    try:
        for _ in range(2):
            watched = observe_quality(stream_fcd(spark, str(source), 1), "quality", reasons=True)
            query = store_split(watched, str(tmp_path / "out"), str(tmp_path / "state"), jobs.DRAIN)
            query.awaitTermination()
            ledger.wait(query)
    finally:
        spark.streams.removeListener(ledger)
    rows = read_quality(spark, path)
    assert rows.select("run").distinct().count() == 1
    got = {(r.batch, r.reject): r.records for r in rows.collect()}
    assert got == {(0, None): 2, (0, "field count"): 2, (0, "device_id"): 1, (1, None): 1, (2, "field count"): 1}
    totals = {r.reject: r.records for r in quality_totals(spark, path).collect()}
    assert totals == {r.reject: r.records for r in reject_counts(parsed_fcd_tsv(spark, str(source))).collect()}
    # A batch that is run again replaces its rows.
    counts = dict.fromkeys(REASONS, 0) | {"good": 2, "field count": 2, "device_id": 1}
    ledger.store(rows.first().run, 0, counts)
    assert {(r.batch, r.reject): r.records for r in read_quality(spark, path).collect()} == got
