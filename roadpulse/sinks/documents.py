"""Grid results as search documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.sinks.files import minute_bucket, window_folder, write_windows

RESOURCE = "thessaloniki/floating-cars"  # fixed value: index and document type


def to_documents(results: DataFrame) -> DataFrame:
    """``cellid, location ("lat,lon"), vehicles, timestamp``."""
    location = F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string"))
    return results.select("cellid", location.alias("location"), "vehicles", "timestamp")


def with_document_id(documents: DataFrame) -> DataFrame:
    """One id per cell and window: a repeated write replaces the document."""
    return documents.withColumn("doc_id", F.concat_ws("|", "cellid", "timestamp"))


def write_documents(
    results: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    level: str = "day",
) -> StreamingQuery | None:
    """Documents with their ids as JSON files, in one folder per ``level`` of the window end.

    A batch replaces the windows it writes, so a repeated run leaves the same documents. A
    stream puts each micro-batch into a part of its own (``batch=``), which is overwritten
    when the batch is replayed after a failure, and then enters it in a ledger beside
    ``path``; ``read_documents`` gives what has been entered, each id once.
    """
    documents = with_document_id(to_documents(results))
    if not results.isStreaming:
        bucket = minute_bucket(F.col("timestamp"))
        return write_windows(documents.withColumn("bucket", bucket), path, None, "json", None, level, bucket)
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")

    def store(batch: DataFrame, number: int) -> None:
        store_batch(batch, number, path, level)

    writer = documents.writeStream.foreachBatch(store).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def store_batch(documents: DataFrame, number: int, path: str, level: str = "day") -> None:
    """One micro-batch in the folders of its windows; a repeated number replaces its part.

    Documents first, the ledger last: a batch that failed in between is not read, and its
    replay writes both again. An empty batch replaces nothing and is entered as well.
    """
    folder = window_folder(minute_bucket(F.col("timestamp")), level).alias(level)
    rows = documents.select("*", folder, F.lit(number).alias("batch"))
    writer = rows.repartition(F.col(level)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(level, "batch").json(path)
    spark = documents.sparkSession
    entry = spark.createDataFrame([(number,)], "batch bigint")
    entry.coalesce(1).write.mode("overwrite").json(f"{ledger_path(path)}/entry={number}")


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}-ledger"


DOCUMENTS = "cellid int, location string, vehicles bigint, timestamp string, doc_id string"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents that a stream has stored: those of entered batches, and of several with one
    id, as after a start from scratch, that of the last batch."""
    entered = spark.read.schema("batch bigint").json(ledger_path(path)).select("batch").distinct()
    stored = spark.read.schema(f"{DOCUMENTS}, batch bigint").json(path)
    fields = F.struct(*(part.split()[0] for part in DOCUMENTS.split(", ")))
    rows = stored.join(entered, "batch", "left_semi").groupBy("doc_id")
    return rows.agg(F.max_by(fields, "batch").alias("last")).select("last.*")


def write_search_index(
    results: DataFrame,
    nodes: str,
    resource: str = RESOURCE,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Documents into a search index. Needs the Elasticsearch package for Spark."""
    documents = with_document_id(to_documents(results))
    options = {
        "es.nodes": nodes,
        "es.resource": resource,
        "es.mapping.id": "doc_id",
        "es.mapping.exclude": "doc_id",
        "es.write.operation": "index",
    }
    if not results.isStreaming:
        documents.write.format("org.elasticsearch.spark.sql").options(**options).mode("append").save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = documents.writeStream.format("org.elasticsearch.spark.sql").options(**options)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()
