"""Counts of good and rejected records of each micro-batch of a stream."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from roadpulse.operators.clean import REASONS

LAYOUT = "run string, batch bigint, reject string, records bigint"


class QualityLedger(StreamingQueryListener):
    """Writes what ``observe_quality`` (with reasons) has counted under ``name`` in each
    micro-batch to a table at ``path``: one row for the good records (``reject`` is NULL) and one for each reason
    that occurs. A batch that is run again after a failure replaces its rows.

    The counts come with the progress of a query, so they cost no further pass. Register it
    with ``spark.streams.addListener`` before the query starts. Progress arrives a little after a
    batch, in order and before the news that the query has ended: ``wait`` waits for that.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "quality"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = (progress.observedMetrics or {}).get(self.name)
        if counts is not None:
            self.store(str(progress.id), progress.batchId, counts.asDict())

    def store(self, run: str, batch: int, counts: dict[str, int]) -> None:
        kinds = [(None, counts["good"]), *((reason, counts[reason]) for reason in REASONS)]
        rows = [(run, batch, reason, number) for reason, number in kinds if number]
        table = self.spark.createDataFrame(rows, LAYOUT).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.path}/query={run}/part={batch}")

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all batches of a query that has ended are written."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError("the end of the stream was not reported")
            time.sleep(0.05)


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    """``run`` (id of the query), ``batch``, ``reject`` and ``records`` of all batches."""
    return spark.read.schema(LAYOUT).option("recursiveFileLookup", True).parquet(path)


def quality_totals(spark: SparkSession, path: str) -> DataFrame:
    """Records per outcome over all batches, as ``reject_counts`` gives for a batch."""
    return read_quality(spark, path).groupBy("reject").agg(F.sum("records").alias("records"))
