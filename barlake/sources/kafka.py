"""Kafka source and sink options (need the Spark Kafka connector on the class path)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = ("key", "value", "partition", "offset")


def as_text(data: Column) -> Column:
    """Bytes read as UTF-8; what is not UTF-8 becomes U+FFFD, so a dead letter can hold any payload."""
    return F.make_valid_utf8(data.cast("string"))


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None
) -> DataFrame:
    """Stream of a topic from its first offset; progress lives in the checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_records is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    texts = [as_text(F.col(name)).alias(name) for name in ("key", "value")]
    return reader.load().select(*texts, "partition", "offset")


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Write ``key``/``value`` rows and wait for every replica."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "5")
        .option("topic", topic)
        .save()
    )
