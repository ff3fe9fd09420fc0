import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from roadpulse.session import checkpoint_root, materialize, scratch_path


def session(named, current=None, master="yarn"):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current)
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert checkpoint_root(session("hdfs:///shared")) == "hdfs:///shared"
    assert checkpoint_root(session(None, "hdfs:///set")) == "hdfs:///set"
    assert scratch_path(session("hdfs:///shared/"), "a").startswith("hdfs:///shared/a-")
    with pytest.raises(RuntimeError):
        checkpoint_root(session(None))


def test_local_session(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    table = materialize(spark.range(100), "numbers", "id")
    assert table.count() == 100
    assert len(table.inputFiles()) <= 4


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from roadpulse.session import build_session, ship_package

spark = build_session("elsewhere", "local[1]", **{"spark.ui.enabled": "false"})
ship_package(spark)

def found(rows):
    import roadpulse.schema
    for row in rows:
        yield row.assign(id=len(roadpulse.schema.EVENT_COLUMNS))

print(spark.range(1).mapInPandas(found, "id long").first()[0])
"""


def test_workers_in_another_folder_get_the_package(tmp_path):
    root = Path(__file__).resolve().parent.parent
    (tmp_path / "job.py").write_text(ELSEWHERE)
    clean = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "job.py", str(root)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.strip().endswith("8"), done.stderr[-2000:]
