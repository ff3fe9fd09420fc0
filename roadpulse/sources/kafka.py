"""Events on Kafka topics. Needs the Kafka package of Spark on the class path, and the Avro
package for Avro messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.messages import decode_event
from roadpulse.functions.text import parse_event_time
from roadpulse.operators.clean import split_valid
from roadpulse.schema import EVENT_COLUMNS

GROUP = "taxi"  # fixed value: the consumer group


def topic_options(
    brokers: str,
    topic: str,
    group: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the topic source, from its first offset.

    Without ``group`` each query has one of its own. Queries that share a group may each
    get only a part of the topic.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if group is not None:
        options["kafka.group.id"] = group
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def parsed_fcd_kafka(
    spark: SparkSession,
    brokers: str,
    topic: str,
    group: str | None = None,
    max_offsets_per_trigger: int | None = None,
    layout: str = "avro",
) -> DataFrame:
    """Stream of the records of a topic with ``reject``."""
    options = topic_options(brokers, topic, group, max_offsets_per_trigger)
    return parse_messages(spark.readStream.format("kafka").options(**options).load(), layout)


def read_fcd_kafka(
    spark: SparkSession,
    brokers: str,
    topic: str,
    group: str | None = None,
    max_offsets_per_trigger: int | None = None,
    layout: str = "avro",
) -> DataFrame:
    """Stream of the good events of a topic."""
    parsed = parsed_fcd_kafka(spark, brokers, topic, group, max_offsets_per_trigger, layout)
    return split_valid(parsed)[0]


def parse_messages(messages: DataFrame, layout: str = "avro") -> DataFrame:
    """Event columns, ``line`` (the message in base 64) and ``reject`` of messages.

    A message that cannot be read, or lacks a field, is rejected with the name of its first
    missing field; nothing fails.
    """
    decoded = messages.select(
        decode_event(F.col("value"), layout).alias("_e"),
        F.base64(F.col("value").cast("binary")).alias("line"),
    )
    fields = {name: F.col(f"_e.{name}") for name in EVENT_COLUMNS}
    fields["timestamp"] = parse_event_time(fields["timestamp"])
    rows = decoded.select(*(value.alias(name) for name, value in fields.items()), "line")
    reject = F.when(F.col("device_id").isNull(), "device_id")
    for name in EVENT_COLUMNS[1:]:
        reject = reject.when(F.col(name).isNull(), name)
    return rows.withColumn("reject", reject)


def from_messages(messages: DataFrame, layout: str = "avro") -> DataFrame:
    """The good events of messages."""
    return split_valid(parse_messages(messages, layout))[0]
