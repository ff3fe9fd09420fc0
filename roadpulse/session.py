"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Timestamps are parsed and printed in UTC, whatever the machine's zone is.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window and duplicate state outgrows the heap on large streams.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app: str = "roadpulse", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, which may run in another folder or on another
    machine. Not needed, and not done, where it is on the workers' path already: in
    ``PYTHONPATH`` or among the submitted files. Done once for each Spark application."""
    package = Path(__file__).resolve().parent
    context = spark.sparkContext
    paths = [Path(path).resolve() for path in os.environ.get("PYTHONPATH", "").split(os.pathsep) if path]
    submitted = context.getConf().get("spark.submit.pyFiles", "") or ""
    if package.parent in paths or package.name in submitted or context.applicationId in _shipped:
        return spark
    archive = Path(tempfile.mkdtemp(prefix="roadpulse-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    # The driver serves the archive to executors from here.
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
    return spark


_shipped: set[str] = set()


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; on a cluster that would not be
    seen by all executors, so there it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="roadpulse-"))
        root = context.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared one."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, purpose: str, *spread_by: str) -> DataFrame:
    """Cut the lineage: write a table in the shared folder and read it back.

    Unlike a checkpoint of the plan this computes the rows once. ``spread_by`` divides
    the table evenly whatever the division of ``rows`` is.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, purpose)
    if spread_by:
        rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *spread_by)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
