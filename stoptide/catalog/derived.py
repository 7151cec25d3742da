"""Frames the registered queries share, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import content_digest
from ..operators.latest import last_observation
from ..plans import gold
from ..sources import frames


def stops(spark: SparkSession, sf: str) -> DataFrame:
    return gold.stop_table(frames.observations(spark, sf))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return gold.trip_table(stops(spark, sf))


def last(spark: SparkSession, sf: str) -> DataFrame:
    return last_observation(frames.observations(spark, sf))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return gold.segment_table(stops(spark, sf), frames.stations(spark, sf))


def geometry(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding, three times in a row, as the points of a track."""
    values = F.concat("embedding", "embedding", "embedding")
    key = F.col("vec_id")
    return frames.table(spark, sf, "embeddings").select(
        "vec_id",
        F.concat(F.lit("S"), F.expr("vec_id div 25")).alias("from_station"),
        F.concat(F.lit("S"), key % 25).alias("to_station"),
        (key * 137 % 90_000).alias("metres"),
        F.transform(values, lambda v, i: F.array(i.cast("double"), v.cast("double")))
        .alias("coordinates"),
    )


def polls(spark: SparkSession, sf: str) -> DataFrame:
    """Poll rows with the digest of their content."""
    return frames.poll_rows(spark, sf).withColumn("digest", content_digest("content"))
