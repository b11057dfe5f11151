"""Messages of a Kafka topic. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The columns that tell a message's place in its topic: for the order of a replay-safe upsert.
PLACE = ("topic", "partition", "offset")


def kafka_options(servers: str, topic: str, *, starting: str = "latest",
                  group: str | None = None, max_offsets: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Reader options. ``starting`` counts for the first start only; later ones
    go on from the offsets in the checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic,
        "startingOffsets": starting, "kafka.group.id": group,
        "maxOffsetsPerTrigger": max_offsets, "minPartitions": min_partitions,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def kafka_messages(spark: SparkSession, servers: str, topic: str, fmt: str = "kafka",
                   **settings) -> DataFrame:
    """Stream of messages with key and value as strings, from the connector
    registered as ``fmt``."""
    return as_messages(
        spark.readStream.format(fmt).options(**kafka_options(servers, topic, **settings)).load())


def as_messages(log: DataFrame) -> DataFrame:
    """Key and value of a message log, which are bytes, as strings."""
    return log.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp")
