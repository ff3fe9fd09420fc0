"""Writing to Kafka topics. Needs the Kafka package of Spark on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.messages import encode_event

TOPIC_PREFIX = "road-"


def to_messages(events: DataFrame, layout: str = "avro") -> DataFrame:
    """Events as messages: Avro binary or JSON text in ``value``."""
    return events.select(encode_event(layout).alias("value"))


def key_by_segment(results: DataFrame) -> DataFrame:
    """Road results as messages for one topic; a segment's results stay in order, as its id
    is the key. This scales with any number of segments."""
    return results.select(
        F.col("segment_id").alias("key"), F.to_json(F.struct(*results.columns)).alias("value")
    )


def route_by_segment(results: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Road results as messages with one topic per road segment. For many segments use
    ``key_by_segment``.

    Characters a topic name cannot have become ``_``.
    """
    topic = F.concat(F.lit(prefix), F.regexp_replace("segment_id", "[^A-Za-z0-9._-]", "_"))
    return results.select(
        topic.alias("topic"),
        F.col("segment_id").alias("key"),
        F.to_json(F.struct(*results.columns)).alias("value"),
    )


def write_fcd_kafka(
    events: DataFrame,
    brokers: str,
    topic: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    layout: str = "avro",
) -> StreamingQuery | None:
    """Events to one topic."""
    return write_messages(to_messages(events, layout), brokers, topic, checkpoint, trigger)


def write_messages(
    messages: DataFrame,
    brokers: str,
    topic: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Messages to ``topic``, or each to the topic in its ``topic`` column."""
    options = {"kafka.bootstrap.servers": brokers, "kafka.acks": "all"}
    if topic is not None:
        options["topic"] = topic
    if not messages.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = messages.writeStream.format("kafka").options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
