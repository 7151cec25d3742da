"""Kafka. The connector is a separate Spark package; only the row shapes are fixed here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

# The version header every message carries.
VERSION_HEADER = "schema_version"
SCHEMA_VERSION = "1"


def record_stream(spark: SparkSession, servers: str, topic: str, *,
                  starting: str = "earliest", max_offsets: int | None = None,
                  **options: str) -> DataFrame:
    """The topic as Bronze records. Offsets live in the query's checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "true")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    for key, value in options.items():
        reader = reader.option(key, value)
    return as_records(reader.load())


def record_batch(spark: SparkSession, servers: str, topic: str, *,
                 starting: str = "earliest", ending: str = "latest",
                 **options: str) -> DataFrame:
    """A bounded range of the topic."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("endingOffsets", ending)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return as_records(reader.load())


def as_records(messages: DataFrame) -> DataFrame:
    """The connector's columns as Bronze records: key and value as text, time as epoch ms."""
    return messages.select(
        F.col("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.unix_millis(F.col("timestamp")).alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def as_messages(observations: DataFrame) -> DataFrame:
    """One message per observation: key = stop id, value = the whole row as JSON."""
    fields = [f.name for f in S.PAYLOAD if f.name in observations.columns]
    header = F.struct(
        F.lit(VERSION_HEADER).alias("key"),
        F.lit(SCHEMA_VERSION).cast("binary").alias("value"),
    )
    return observations.select(
        F.col("stop_id").cast("binary").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
        .cast("binary").alias("value"),
        F.array(header).alias("headers"),
    )


def write_messages(observations: DataFrame, servers: str, topic: str,
                   **options: str) -> None:
    """Publish; a task fails when the broker does not confirm its messages."""
    writer = (
        as_messages(observations).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "gzip")
        .option("kafka.linger.ms", "20")
    )
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()
