"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_row(df: DataFrame, keys: Sequence[str], *newest_first: Column) -> DataFrame:
    """The newest row per key.

    Spark keeps only the best row per key and task before the shuffle
    (`WindowGroupLimit`), so a key that holds most of the rows costs one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def last_observation(observations: DataFrame) -> DataFrame:
    """Collapse the series of a stop to its last observation; later offsets win ties."""
    return latest_row(observations, ["stop_id"],
                      F.col("observed_at").desc(), F.col("kafka_offset").desc())


def first_with_count(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """First candidate, in the given order, that has a count above zero.

    `candidates` is (name, candidates array), `counts` is (eva, calls). A name without any
    such candidate has no row.
    """
    tried = candidates.select("name", F.posexplode("candidates").alias("position", "eva"))
    answered = tried.join(counts.filter("calls > 0"), "eva")
    best = F.min_by(F.struct("eva", "calls", "position"), "position")
    return answered.groupBy("name").agg(best.alias("best")).select("name", "best.*")


def main_eva(eva_numbers: Column) -> Column:
    """The first number flagged as main, NULL if none is."""
    mains = F.filter(eva_numbers, lambda e: F.coalesce(e["isMain"], F.lit(False)))
    return F.get(mains, F.lit(0))["number"]


def latest_plan(plan: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """A later fetch replaces an earlier one; plans of trips that began before the cutoff go.

    `cutoff` is a YYMMDD text, compared with the start date in the stop id.
    """
    if cutoff is not None:
        start = F.regexp_extract("stop_id", r"^.*-([^-]*)-[^-]*$", 1)
        plan = plan.filter(F.substring(start, 1, 6) >= cutoff)
    return latest_row(plan, ["stop_id"], F.col("fetched_at").desc())
