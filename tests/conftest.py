import os
import sys
import time
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from roadpulse.schema import EVENT_SCHEMA
from roadpulse.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Build events from rows of (device, time text, lon, lat, speed)."""

    def build(rows):
        short = spark.createDataFrame(
            rows, "device_id int, timestamp string, lon double, lat double, speed double"
        )
        return short.selectExpr(
            "device_id",
            "cast(timestamp as timestamp) as timestamp",
            "lon",
            "lat",
            "0e0 as altitude",
            "speed",
            "0e0 as orientation",
            "0 as transfer",
        ).to(EVENT_SCHEMA)

    return build


@pytest.fixture
def drop_file():
    """Put a text file into a stream's folder; the n-th one is n seconds newer."""

    def put(folder, name, lines, order):
        hidden = Path(folder) / f".{name}"
        hidden.write_text("".join(line + "\n" for line in lines))
        stamp = time.time() - 3600 + order
        os.utime(hidden, (stamp, stamp))
        hidden.rename(Path(folder) / name)

    return put
