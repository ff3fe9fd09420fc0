import json
import shutil
from pathlib import Path

import pytest
from fcd_lines import tsv
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roadpulse.__main__ import arguments
from roadpulse.functions.messages import encode_event
from roadpulse.operators.clean import to_tsv_line
from roadpulse.operators.traffic import grid_traffic, road_traffic
from roadpulse.plans import jobs
from roadpulse.sinks import documents, files, kafka
from roadpulse.sources.files import read_fcd_tsv
from roadpulse.sources.kafka import from_messages, parse_messages, topic_options
from roadpulse.streaming.event_time import late_rows

ROWS = [
    (1, "2017-01-01 00:00:10", 22.948426, 40.626444, 30.0),
    (2, "2017-01-01 00:01:10", 22.948426, 40.626444, 50.0),
    (3, "2017-01-01 00:02:10", 22.948426, 40.626444, 70.0),
    (4, "2017-01-01 00:02:20", 22.0, 40.626444, 70.0),
]


def lines_in(folder):
    parts = [p for p in Path(folder).rglob("part-*") if p.suffix != ".crc"]
    return sorted(line for p in parts for line in p.read_text().splitlines())


def test_folders_by_window(spark, tmp_path, events):
    report = grid_traffic(events(ROWS), 2)
    files.write_bucketed(report, str(tmp_path / "out"))
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert folders == ["bucket=2017-01-01--0002", "bucket=2017-01-01--0004"]
    lines = lines_in(tmp_path / "out" / folders[0])
    assert len(lines) == 1
    assert lines[0].startswith("(3660,40.6") and lines[0].endswith(",2,2017-01-01 00:02:00)")
    before = lines_in(tmp_path / "out")
    files.write_bucketed(report, str(tmp_path / "out"))
    assert lines_in(tmp_path / "out") == before


@pytest.mark.parametrize("file_format", ["text", "parquet", "json"])
@pytest.mark.parametrize("level, folder", [("day", "2017-01-01"), ("hour", "2017-01-01--00")])
def test_windows_of_a_day_share_a_folder(spark, tmp_path, events, file_format, level, folder):
    """A later batch replaces its own windows there and leaves the others."""
    path = str(tmp_path / "out")

    def write(rows):
        report = grid_traffic(events(rows), 2)
        files.write_bucketed(report, path, file_format=file_format, level=level)

    def stored():
        rows = spark.read.format(file_format).load(path)
        if file_format == "text":
            return sorted(r.value for r in rows.collect())
        return sorted(f"({r.cellid},{r.vehicles},{r.timestamp})" for r in rows.collect())

    write(ROWS)
    assert [p.name for p in (tmp_path / "out").iterdir() if p.is_dir()] == [f"{level}={folder}"]
    first = stored()
    assert len(first) == 3
    write(ROWS)
    assert stored() == first
    # One window again, with a row more.
    write([*ROWS[:2], (9, "2017-01-01 00:01:30", 22.948426, 40.626444, 1.0)])
    assert [x for x in stored() if "00:02:00" not in x] == [x for x in first if "00:02:00" not in x]
    assert len(stored()) == 3 and stored() != first
    # Another day.
    write([(1, "2017-01-02 00:00:10", 22.948426, 40.626444, 1.0)])
    assert len(stored()) == 4
    with pytest.raises(ValueError):
        files.write_bucketed(grid_traffic(events(ROWS), 2), path, level="week")


def test_many_segments_in_few_files(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(200_000).selectExpr(
        "concat('s', id % 100000) AS segment_id", "cast(id AS string) AS timestamp", "1e0 AS avg_speed", "id AS vehicles"
    )
    files.write_by_segment(rows, path, groups=16)
    parts = list((tmp_path / "out").rglob("part-*.parquet"))
    assert len(list((tmp_path / "out").glob("segment_group=*"))) == 16 and len(parts) <= 64
    one = files.read_segment(spark, path, "s77", 16)
    assert sorted(r.vehicles for r in one.collect()) == [77, 100077]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(segment_group" in plan and "EqualTo(segment_id,s77)" in plan
    for part in parts[:3]:
        names = [r.segment_id for r in spark.read.parquet(str(part)).collect()]
        assert names == sorted(names)
    # A batch replaces its segments and no other of their folders.
    again = rows.where("segment_id = 's77' AND id < 100").withColumn("vehicles", F.lit(5).cast("bigint"))
    files.write_by_segment(again, path, groups=16)
    assert [r.vehicles for r in files.read_segment(spark, path, "s77", 16).collect()] == [5]
    assert spark.read.parquet(path).count() == 199_999


def test_rows_of_a_folder_are_sorted_by_window(spark, tmp_path, events):
    rows = [(i, f"2017-01-01 {i % 24:02d}:{i % 60:02d}:10", 22.948426, 40.626444, 1.0) for i in range(300)]
    path = str(tmp_path / "out")
    files.write_bucketed(grid_traffic(events(rows), 2), path, file_format="parquet", level="day")
    for part in (tmp_path / "out" / "day=2017-01-01").glob("*.parquet"):
        buckets = [r.bucket for r in spark.read.parquet(str(part)).collect()]
        assert buckets == sorted(buckets)


def test_replayed_batch_replaces_its_documents(spark, tmp_path, events):
    path = str(tmp_path / "docs")
    report = grid_traffic(events(ROWS), 2)
    docs = documents.with_document_id(documents.to_documents(report))
    documents.store_batch(docs.where("timestamp like '%02:00'"), 0, path)
    documents.store_batch(docs.where("timestamp like '%04:00'"), 1, path)
    want = sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, documents.read_documents(spark, path).collect())) == want
    documents.store_batch(docs.where("timestamp like '%04:00'"), 1, path)
    assert spark.read.json(path).count() == 3
    # Stored but not entered: a batch that failed between the two is not read ...
    late = docs.withColumn("vehicles", F.lit(99).cast("bigint"))
    documents.store_batch(late, 2, path)
    shutil.rmtree(f"{documents.ledger_path(path)}/entry=2")
    assert sorted(map(tuple, documents.read_documents(spark, path).collect())) == want
    # ... until it is replayed. Then its documents are the last of their ids.
    documents.store_batch(late, 2, path)
    got = documents.read_documents(spark, path).collect()
    assert len(got) == 3 and {r.vehicles for r in got} == {99}
    documents.store_batch(late.limit(0), 3, path)
    assert documents.read_documents(spark, path).count() == 3


def test_stream_of_documents_after_a_restart(spark, tmp_path, drop_file):
    source, sink = tmp_path / "in", str(tmp_path / "docs")
    source.mkdir()
    drop_file(source, "a", [tsv(i, f"2017-01-01 00:0{i}:10.000") for i in range(6)], 0)
    drop_file(source, "z", [tsv(1, "2017-01-01 01:00:00.000")], 1)
    for _ in range(2):
        jobs.stream_grid_from_files(
            spark, str(source), 2, sink, str(tmp_path / "state"), documents=True, trigger=jobs.DRAIN, level="day"
        ).awaitTermination()
    found = documents.read_documents(spark, sink).collect()
    assert sorted(r.timestamp[11:] for r in found) == ["00:02:00", "00:04:00", "00:06:00"]
    # The same files from scratch: other batch numbers, the same documents.
    jobs.stream_grid_from_files(
        spark, str(source), 2, sink, str(tmp_path / "fresh"), documents=True, trigger=jobs.DRAIN, level="day"
    ).awaitTermination()
    assert sorted(documents.read_documents(spark, sink).collect()) == sorted(found)


def test_overwrite(spark, tmp_path, events):
    path = str(tmp_path / "out")
    for rows in (ROWS, ROWS[:2]):
        files.write_overwrite(grid_traffic(events(rows), 2), path)
    assert spark.read.parquet(path).count() == 1


def test_documents(spark, tmp_path, events):
    report = grid_traffic(events(ROWS), 2)
    for _ in range(2):
        documents.write_documents(report, str(tmp_path / "out"))
    docs = [json.loads(line) for line in lines_in(tmp_path / "out")]
    assert len(docs) == 3
    doc = next(d for d in docs if d["timestamp"] == "2017-01-01 00:02:00")
    row = next(r for r in report.collect() if r.timestamp == doc["timestamp"])
    assert doc == {
        "cellid": 3660,
        "location": f"{row.lat!r},{row.lon!r}",
        "vehicles": 2,
        "timestamp": "2017-01-01 00:02:00",
        "doc_id": "3660|2017-01-01 00:02:00",
    }
    ids = documents.with_document_id(documents.to_documents(report)).collect()
    assert len({r.doc_id for r in ids}) == 3 and "3660|2017-01-01 00:02:00" in {r.doc_id for r in ids}


def test_stream_writers(spark, tmp_path, drop_file):
    source = tmp_path / "in"
    source.mkdir()
    drop_file(source, "a", [tsv(1, "2017-01-01 00:00:10.000"), tsv(2, "2017-01-01 00:01:10.000")], 0)
    drop_file(source, "z", [tsv(1, "2017-01-01 01:00:00.000")], 1)
    for name, as_documents in (("text", False), ("json", True)):
        query = jobs.stream_grid_from_files(
            spark,
            str(source),
            2,
            str(tmp_path / name),
            str(tmp_path / f"{name}-state"),
            documents=as_documents,
            trigger=jobs.DRAIN,
        )
        query.awaitTermination()
    assert len(lines_in(tmp_path / "text" / "bucket=2017-01-01--0002")) == 1
    assert [json.loads(line)["vehicles"] for line in lines_in(tmp_path / "json")] == [2]
    with pytest.raises(ValueError):
        files.write_bucketed(jobs.grid_report(jobs.file_events(spark, str(source)), 2), "x")
    query = files.write_console(jobs.grid_report(jobs.file_events(spark, str(source)), 2), jobs.DRAIN)
    query.awaitTermination()


def test_text_export_can_be_read_again(spark, tmp_path, events):
    original = events(ROWS)
    files.write_tsv(to_tsv_line(original), str(tmp_path / "out"))
    with pytest.raises(Exception, match="already exists"):
        files.write_tsv(to_tsv_line(original), str(tmp_path / "out"))
    good, bad = read_fcd_tsv(spark, str(tmp_path / "out"))
    assert sorted(good.collect()) == sorted(original.collect()) and bad.count() == 0


def test_one_topic_per_segment(spark, events):
    matched = events(ROWS).selectExpr("'h 1/2' as segment_id", "timestamp", "speed")
    routed = kafka.route_by_segment(road_traffic(matched)).orderBy("value").collect()
    assert {r.topic for r in routed} == {"road-h_1_2"}
    value = json.loads(routed[0].value)
    assert value == {
        "segment_id": "h 1/2",
        "timestamp": "2017-01-01 00:01:10.000",
        "avg_speed": 40.0,
        "vehicles": 2,
    }


def test_messages_keep_the_event(spark, events):
    rows = ROWS + [(-5, "2017-01-01 00:00:00.001", -22.5, 0.0, 1e300), (2**31 - 1, *ROWS[0][1:])]
    original = events(rows)
    messages = kafka.to_messages(original, "json")
    assert sorted(from_messages(messages, "json").collect()) == sorted(original.collect())


def test_broken_messages_are_rejected(spark):
    good = (
        '{"device_id":1,"timestamp":"2017-01-01 00:00:00.001","lon":1.0,"lat":1.0,"altitude":0.0,'
        '"speed":1.0,"orientation":0.0,"transfer":0}'
    )
    values = [good, good.replace("2017-01-01", "today"), "{", None, good.replace("lon", "x")]
    messages = spark.createDataFrame([(v and v.encode(),) for v in values], "value binary")
    parsed = parse_messages(messages, "json").collect()
    assert [row.reject for row in parsed] == [None, "timestamp", "device_id", "device_id", "lon"]


def test_avro_without_its_package_is_a_clear_error(spark, events):
    with pytest.raises(AnalysisException, match="spark-avro"):
        kafka.to_messages(events(ROWS))
    with pytest.raises(AnalysisException, match="spark-avro"):
        from_messages(spark.createDataFrame([(b"x",)], "value binary"))
    with pytest.raises(ValueError):
        encode_event("xml")


def test_topic_options():
    plain = topic_options("b:1", "taxi")
    assert "kafka.group.id" not in plain and plain["startingOffsets"] == "earliest"
    assert topic_options("b:1", "taxi", "g", 5)["kafka.group.id"] == "g"


def test_keyed_by_segment(spark, events):
    matched = events(ROWS).selectExpr("'h 1/2' as segment_id", "timestamp", "speed")
    keyed = kafka.key_by_segment(road_traffic(matched)).collect()
    assert {row.key for row in keyed} == {"h 1/2"} and len(keyed) == 2


def test_files_are_a_complete_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stamps = [f"2017-01-01 0{h}:0{m}:10.000" for h in range(6) for m in range(6)]
    for part in range(6):
        lines = [tsv(i, stamp) for i, stamp in enumerate(stamps) if i % 6 == part]
        (source / f"f{part}").write_text("\n".join([*lines, "broken"]) + "\n")
    rejected = jobs.grid_from_files(spark, str(source), 2, str(tmp_path / "out"))
    counted = [int(line.split(",")[3]) for line in lines_in(tmp_path / "out")]
    assert sum(counted) == 36 and len(counted) == 18
    assert [row.reject for row in rejected.collect()] == ["field count"] * 6
    rejected = jobs.grid_from_files(spark, str(source), 2, str(tmp_path / "docs"), documents=True)
    assert sum(json.loads(line)["vehicles"] for line in lines_in(tmp_path / "docs")) == 36


@pytest.mark.parametrize("cap", [1, 2, 100, None])
def test_stream_of_ordered_files_does_not_depend_on_the_cap(spark, tmp_path, drop_file, cap):
    source = tmp_path / "in"
    source.mkdir()
    for part in range(6):
        stamps = [f"2017-01-01 0{part}:0{m}:10.000" for m in range(6)]
        drop_file(source, f"f{part}", [tsv(i, stamp) for i, stamp in enumerate(stamps)], part)
    drop_file(source, "tick", [tsv(1, "2017-01-03 00:00:00.000")], 9)
    report = jobs.grid_report(jobs.file_events(spark, str(source), cap), 2)
    query = files.write_bucketed(report, str(tmp_path / "out"), str(tmp_path / "s"), trigger=jobs.DRAIN)
    query.awaitTermination()
    assert sum(int(line.split(",")[3]) for line in lines_in(tmp_path / "out")) == 36
    assert late_rows(query) == 0


def test_arguments():
    parse = arguments().parse_args
    assert parse(["mapmatch", "--input", "a", "--roads", "b"]).window == 2
    consumer = ["consumer-hdfs", "--topic", "t", "--window", "5", "--sink", "s", "--checkpoint", "c"]
    assert parse(consumer).window == 5
    with pytest.raises(SystemExit):
        parse(["consumer-elasticsearch", "--topic", "t"])
