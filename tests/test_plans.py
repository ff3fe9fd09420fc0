"""Plan shapes that large data depends on."""

from roadpulse.operators import clean, geohash
from roadpulse.operators.traffic import geohash_traffic, grid_traffic, road_traffic
from roadpulse.schema import EVENT_COLUMNS
from roadpulse.sources.records import parse_tsv


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_report_shuffles_partial_counts_of_pruned_columns(spark, tmp_path, events):
    path = str(tmp_path / "events")
    events([(1, "2017-01-01 00:00:10", 22.9, 40.6, 30.0)]).write.parquet(path)
    plan = plan_of(grid_traffic(spark.read.parquet(path), 2))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
    assert plan.index("Exchange hashpartitioning(cellid") < plan.index("partial_count")
    read = plan.split("ReadSchema: ")[-1]
    wanted = {"timestamp", "lon", "lat"}
    assert {name for name in EVENT_COLUMNS if f"{name}:" in read} == wanted
    # Centre and label are made from the counts.
    below = plan[plan.index("partial_count") :]
    assert "date_format" not in below and "Python" not in plan


def test_road_and_geohash_reports_shuffle_partial_sums_once(spark, events):
    rows = events([(1, "2017-01-01 00:00:10", 22.9, 40.6, 30.0)])
    matched = rows.selectExpr("'a' as segment_id", "timestamp", "speed")
    for report in (road_traffic(matched, 2), geohash_traffic(rows, 20, 2)):
        plan = plan_of(report)
        assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
        assert "partial_avg" in plan and "Python" not in plan


def test_neighbours_and_rollup_work_on_counts(events):
    rows = events([(1, "2017-01-01 00:00:10", 22.9, 40.6, 30.0)])
    for report in (geohash.geohash_neighbour_density(rows, 30), geohash.geohash_rollup(rows, 4, 5)):
        plan = plan_of(report)
        # One shuffle of counted events, one of what the counts are dealt out to.
        assert plan.count("Exchange") == 2 and plan.count("HashAggregate") == 4
        assert "Join" not in plan and "partial_count" in plan


def test_stored_split_parses_once(spark, tmp_path):
    lines = spark.createDataFrame([("a\tb",)], "value string")
    good, bad = clean.store_split(parse_tsv(lines), str(tmp_path / "split"))
    for rows, outcome in ((good, "good"), (bad, "rejected")):
        plan = plan_of(rows)
        assert "split(" not in plan and "(outcome" in plan and outcome in plan
