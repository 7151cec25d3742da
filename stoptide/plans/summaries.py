"""Summaries of a day that can be added up to any range of days without the rows themselves.

Percentiles: a KLL sketch of the delays per day and route. A quantile of a sketch, and of any
merge of sketches, is an element whose rank is off by at most `rank_error(k)` of the number of
elements, with 99 % confidence; up to k elements it is exact.

Sets of ids: a theta sketch per day. Up to 2 ** lg ids it holds them all and every count is
exact; beyond that, counts are off by about `set_error(lg)` of the size of the union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import share

K, LG = 200, 12
ROUTE = ["origin", "destination"]


def rank_error(k: int = K) -> float:
    """Normalised rank error of a single quantile (the constants are the sketch's own)."""
    return 2.296 / k ** 0.9021


def set_error(lg: int = LG) -> float:
    """Two standard errors, as a share of the union."""
    return 2 / 2 ** (lg / 2)


def delay_sketches(trips: DataFrame, k: int = K) -> DataFrame:
    """(service_date, origin, destination, trips, delays): a row per day and long-distance route.

    `delays` is the sketch of the known arrival delays; a day without any has none.
    """
    delay = F.col("arrival_delay_at_last_observed").cast("long")
    rows = trips.filter("is_long_distance").select("service_date", *ROUTE, delay.alias("delay"))
    made = rows.groupBy("service_date", *ROUTE).agg(
        F.count(F.lit(1)).alias("trips"), F.count("delay").alias("known"),
        F.expr(f"kll_sketch_agg_bigint(delay, {int(k)})").alias("sketch"))
    return made.select("service_date", *ROUTE, "trips",
                       F.when(F.col("known") > 0, F.col("sketch")).alias("delays"))


def delay_percentiles(sketches: DataFrame, keys: Sequence[str], points: dict[str, float]
                      ) -> DataFrame:
    """Percentiles per `keys` over all rows of `sketches`, which may be any choice of days."""
    merged = sketches.filter("delays IS NOT NULL").groupBy(*keys).agg(
        F.expr("kll_merge_agg_bigint(delays)").alias("merged"))
    asked = ", ".join(f"{float(p)}D" for p in points.values())
    found = merged.withColumn("q", F.expr(
        f"kll_sketch_get_quantile_bigint(merged, array({asked}))"))
    return found.select(*keys, F.expr("kll_sketch_get_n_bigint(merged)").alias("known"), *[
        F.get("q", F.lit(i)).cast("double").alias(name) for i, name in enumerate(points)])


def id_sketches(rows: DataFrame, day: Column, key: str, lg: int = LG) -> DataFrame:
    """(day, ids): a sketch of the different ids of each day; NULL ids do not count."""
    return rows.select(day.alias("day"), F.col(key).alias("id")).groupBy("day").agg(
        F.expr(f"theta_sketch_agg(id, {int(lg)})").alias("ids"))


def compare_sets(pairs: DataFrame, left: str = "left_ids", right: str = "right_ids"
                 ) -> DataFrame:
    """`pairs` of sketches with the numbers of `reconcile.reconcile_ids`, from them alone."""
    def size(what: str) -> Column:
        return F.expr(f"theta_sketch_estimate({what})")

    counted = pairs.withColumns({
        "matched": size(f"theta_intersection({left}, {right})"),
        "only_left": size(f"theta_difference({left}, {right})"),
        "only_right": size(f"theta_difference({right}, {left})")}).drop(left, right)
    return counted.withColumns({
        "pct_of_left": share(F.col("matched"), F.col("matched") + F.col("only_left")),
        "pct_of_right": share(F.col("matched"), F.col("matched") + F.col("only_right"))})


def days_with_the_next(sketches: DataFrame) -> DataFrame:
    """Every day's sketch beside that of the next day there is; a row per day, whatever ids."""
    order = Window.orderBy("day")
    return sketches.withColumnRenamed("ids", "left_ids").withColumns({
        "next_day": F.lead("day").over(order),
        "right_ids": F.lead("left_ids").over(order)}).filter("next_day IS NOT NULL")
