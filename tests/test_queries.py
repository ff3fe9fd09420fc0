"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("events", "customer"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert set(driver.road_queries()) == set(driver.road_sql())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["cellid", "lat", "lon", "vehicles", "timestamp"]
    assert result.count() == 998


@pytest.mark.parametrize("name", driver.road_queries())
def test_query(spark, tables, name):
    result = driver.road_queries()[name](spark, SF_DIR)
    cursor = tables.execute(driver.road_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert ordered(map(tuple, result.select(*columns).collect())) == ordered(cursor.fetchall())


def test_json_arrays_are_of_bounded_length(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "arrays")
    monkeypatch.setattr(driver, "scratch_path", lambda *_: path)
    monkeypatch.setattr(driver, "ARRAY_RECORDS", 10, raising=False)
    driver.json_array_file(spark, SF_DIR)
    arrays = [row.value for row in spark.read.text(path).collect()]
    assert max(array.count("{") for array in arrays) == 10
    files = [row.value for row in spark.read.text(path, wholetext=True).collect()]
    assert max(file.count("{") for file in files) <= 160
