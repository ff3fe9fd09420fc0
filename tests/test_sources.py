import gzip
import json
from datetime import datetime

import pytest
from fcd_lines import tsv

from roadpulse.operators.clean import to_gps_columns
from roadpulse.schema import EVENT_SCHEMA, GPS_SCHEMA
from roadpulse.sources import files
from roadpulse.sources.records import parse_json_array
from roadpulse.sources.records import parse_tsv

GOOD = tsv(84037, "2017-01-01 00:00:01.500", speed=35.5)
STAMP = "2017-01-01 00:00:02.000"


def test_text(spark, tmp_path):
    lines = [
        GOOD,
        f"1\t{STAMP}\t22.9\t40.6\t\t1.0\t90.0\t1",
        f"2\t{STAMP}\t22.9\t40.6\t0.0\t1.0\t\t1",
        f"3\t{STAMP}\t22.9\t40.6\t0.0\t1.0\t45.0\t",
        f"4\t{STAMP}\t\t\t\t\t\t",
        f"5\t{STAMP}",
        f"6\t{STAMP}\teast\t40.6\t0.0\t1.0\t45.0\t0",
        "7\t2017-01-01\t22.9\t40.6\t0.0\t1.0\t45.0\t0",
        f"\t{STAMP}\t22.9\t40.6\t0.0\t1.0\t45.0\t0",
        f"9.5\t{STAMP}\t22.9\t40.6\t0.0\t1.0\t45.0\t0",
        f"10\t{STAMP}\t22.9\t40.6\t0.0\t1.0\t45.0\t1.5",
        "11\t2017-02-30 00:00:00.000\t22.9\t40.6\t0.0\t1.0\t45.0\t0",
        f"12\t{STAMP}\t22.9\t40.6\t0.0\t1.0\t45.0\t0\textra",
        f"13\t{STAMP}\t22.9\t40.6\t0.0\tNaN\t45.0\t0",
        f"14\t{STAMP}\t22.9\t40.6\t0.0\t1e10\t45.0\t0",
        "",
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    good, bad = files.read_fcd_tsv(spark, str(tmp_path / "a.csv"))
    assert good.schema.simpleString() == EVENT_SCHEMA.simpleString()
    rows = {r.device_id: r for r in good.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 84037]
    assert rows[84037].timestamp == datetime(2017, 1, 1, 0, 0, 1, 500000)
    assert (rows[84037].orientation, rows[84037].speed) == (90.0, 35.5)
    assert rows[1].altitude == 0.0 and rows[2].orientation == 0.0 and rows[3].transfer == 0
    assert tuple(rows[4])[2:] == (0.0,) * 5 + (0,)
    reasons = {r.line.split("\t")[0]: r.reject for r in bad.collect()}
    assert reasons == {
        "5": "field count",
        "6": "lon",
        "7": "timestamp",
        "": "field count",
        "9.5": "device_id",
        "10": "transfer",
        "11": "timestamp",
        "12": "field count",
        "13": "speed",
        "14": "speed",
    } or reasons[""] in ("field count", "device_id")
    assert bad.count() == 11
    assert files.read_fcd_tsv(spark, str(tmp_path / "a.csv"), partitions=3)[0].count() == 5


def test_gzip_and_counts_do_not_depend_on_the_columns_read(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write(f"{GOOD}\n6\t{STAMP}\t22.9\t40.6\t0.0\tfast\t45.0\t0\n")
    good, bad = files.read_fcd_tsv(spark, str(tmp_path / "a.csv.gz"))
    assert good.count() == good.select("lon").count() == good.select("speed").count() == 1
    assert bad.select("reject").first().reject == "speed"
    assert not (tmp_path / "a.csv").exists()


def test_each_line_is_parsed_once(spark):
    lines = spark.createDataFrame([(GOOD,)], "value string")
    good, _ = files.split_valid(parse_tsv(lines))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan


RECORD = {
    "device_random_id": 79163,
    "recorded_timestamp": "2017-01-01 00:00:01.500",
    "lon": 22.948426,
    "lat": 40.626444,
    "altitude": 12.0,
    "speed": 35,
    "orientation": 90.0,
    "transfer": 1,
}


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_json(spark, tmp_path, layout):
    items = [
        RECORD,
        {**RECORD, "device_random_id": ""},
        {**RECORD, "device_random_id": "81", "speed": 35.9},
        {**RECORD, "device_random_id": 82, "recorded_timestamp": "yesterday"},
        {**RECORD, "device_random_id": 83, "lon": "east"},
        {k: v for k, v in RECORD.items() if k != "device_random_id"},
        {**{k: v for k, v in RECORD.items() if k != "altitude"}, "device_random_id": 84},
    ]
    if layout == "array":
        text = json.dumps(items)
    else:
        text = "\n".join(json.dumps(item) for item in items) + "\n{not json\n"
    (tmp_path / "a.json").write_text(text)
    good, bad = files.read_fcd_json(spark, str(tmp_path / "a.json"), layout)
    assert good.schema.simpleString() == EVENT_SCHEMA.simpleString()
    rows = {r.device_id: r for r in good.collect()}
    assert sorted(rows) == [81, 84, 79163]
    assert rows[81].speed == 35.0 and rows[79163].transfer == 1 and rows[84].altitude == 0.0
    reasons = sorted(r.reject for r in bad.collect())
    assert reasons == ["device_id"] * (1 if layout == "array" else 2) + ["lon", "timestamp"]


def test_damaged_array(spark, tmp_path):
    items = [{**RECORD, "device_random_id": i} for i in range(1, 101)]
    text = json.dumps(items)
    (tmp_path / "a.json").write_text(text[:-20])
    (tmp_path / "b.json").write_text("[]")
    good, bad = files.read_fcd_json(spark, str(tmp_path))
    assert sorted(row.device_id for row in good.collect()) == list(range(1, 100))
    left = bad.collect()
    assert [row.reject for row in left] == ["array"] and '"device_random_id": 100' in left[0].line


@pytest.mark.parametrize("header", [True, False])
def test_archive(spark, tmp_path, events, header):
    archive = to_gps_columns(events([(7, "2017-01-01 00:00:01.5", 22.9, 40.6, 35.9)]))
    for part in "ab":
        lines = [",".join(GPS_SCHEMA.fieldNames())] if header else []
        lines += [",".join(str(v) for v in archive.first()), "1,2"]
        (tmp_path / f"{part}.csv").write_text("\n".join(lines))
    good, bad = files.read_gps_csv(spark, str(tmp_path), header)
    assert good.collect() == archive.collect() * 2
    assert [r.reject for r in bad.collect()] == ["field count"] * 2
    event = files.read_gps_events(spark, str(tmp_path), header).first()
    assert event.orientation == 0.0 and event.timestamp == datetime(2017, 1, 1, 0, 0, 1, 500000)


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        files.read_fcd_json(spark, "x", "rows")
    with pytest.raises(ValueError):
        files.stream_fcd(spark, "x", file_format="csv")


ARRAYS = {
    "one": "[{0}, {1},{2}\n, {3}]\n",
    "empty": "[]",
    "blank": " \n",
    "nothing": "",
    "several": "[{0}] [{1},{2}]\n[]",
    "bare": "{0}{1}",
    "commas": "{0},{1}",
    "cut": "[{0}, {1}, {{\"device_random_id\": 5",
    "cut after a brace": "[{0}, {1}",
    "cut before the frame": "[{0}, {1},",
    "cut to a whole value": "[{0}, {{\"device_random_id\": 5, \"lon\": 22.9",
    "damaged": "[{0}, {{\"device_random_id\": {1}, oops {2} ]",
    "braces": "[{0}, }} {1} {{ ]",
    "words": "see [{0}] above",
    "mark": "\ufeff[{0},{1}]",
    "marked and cut": "\ufeff[{0},{{\"device_random_id\": 7, \"lon\": 2",
    "letters": "[{0}, {{\"device_random_id\": \"\u03b1\u03b2\", \"lon\": 1}}]",
}


@pytest.mark.parametrize("size", [40, 1 << 27])
@pytest.mark.parametrize("name", ARRAYS)
def test_arrays_are_read_in_pieces(spark, tmp_path, name, size):
    """The same rows and rejects as from the whole text, however the file is divided."""
    items = [
        json.dumps({"device_random_id": i or "", "recorded_timestamp": f"2017-01-01 00:00:0{i}.000", "lon": 22.9, "speed": 3})
        for i in range(4)
    ]
    text = ARRAYS[name].format(*items)
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    (tmp_path / "other.json").write_text("[" + items[1] + "]")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        path = str(tmp_path)
        texts = spark.read.text(path, wholetext=True).selectExpr("ltrim('\ufeff', value) AS value")
        want = parse_json_array(texts).collect()
        got = files.parsed_json_arrays(spark, path).collect()
        if size == 40 and len(text) > 300:
            assert files._pieces(spark, path).selectExpr("spark_partition_id()").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r[:8] for r in got if r.reject is None) == sorted(r[:8] for r in want if r.reject is None)
    assert sorted(r.reject for r in got if r.reject) == sorted(r.reject for r in want if r.reject)


def test_compressed_arrays_beside_others(spark, tmp_path):
    item = '{"device_random_id": 1, "recorded_timestamp": "2017-01-01 00:00:01.000"}'
    with gzip.open(tmp_path / "a.json.gz", "wt") as file:
        file.write(f"[{item}, {item}, {{")
    (tmp_path / "b.json").write_text(f"[{item}]")
    for path, good, bad in ((tmp_path, 3, 1), (tmp_path / "a.json.gz", 2, 1), (tmp_path / "b.json", 1, 0)):
        rows, rejects = files.read_fcd_json(spark, str(path))
        assert (rows.count(), rejects.count()) == (good, bad)
