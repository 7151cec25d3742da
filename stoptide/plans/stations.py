"""Which stations to poll, and the station dimension of the map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_strict_long_distance
from ..operators.latest import first_with_count, main_eva
from ..operators.ranks import running_total

# Stations the master data does not cover (EVA, latitude, longitude).
MANUAL_COORDINATES = [
    (8500010, 47.5474, 7.5898),
    (8000026, 47.5672, 7.6077),
]


def manual_coordinates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MANUAL_COORDINATES, "eva BIGINT, manual_latitude DOUBLE, manual_longitude DOUBLE")


def route_call_counts(plan: DataFrame) -> DataFrame:
    """How often each station name occurs on the routes of long-distance stops."""
    names = F.concat(
        F.coalesce(F.split("planned_path_from", r"\|"), F.array().cast("array<string>")),
        F.coalesce(F.split("planned_path_to", r"\|"), F.array().cast("array<string>")))
    return (
        plan.filter(is_strict_long_distance(F.col("train_filter")))
        .select(F.explode(names).alias("name")).filter("name <> ''")
        .groupBy("name").agg(F.count(F.lit(1)).alias("route_calls"))
    )


def category_rollup(stations: DataFrame) -> DataFrame:
    """Stations per category with the running total, the unknown category last."""
    counts = stations.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return running_total(counts, "category", "n", "cumulative")


def seed_stations(stations: DataFrame) -> DataFrame:
    """Main number of every station of the top category."""
    return stations.filter("category = 1").select(
        main_eva(F.col("evaNumbers")).alias("eva")).filter("eva IS NOT NULL")


def poll_targets(calls: DataFrame, candidates: DataFrame, counts: DataFrame,
                 master: DataFrame, wanted: int) -> DataFrame:
    """The `wanted` most called stations that have a number with long-distance trains.

    `candidates` is (name, candidates array), the canonical number first; `counts` is
    (eva, calls) of one probed hour; `master` the exploded station master.
    """
    chosen = first_with_count(candidates, counts).select("name", "eva")
    top = calls.join(chosen, "name").orderBy(F.col("route_calls").desc(), "name").limit(wanted)
    return top.join(
        master.select("eva", "stada_name", "station_number", "category", "federal_state",
                      "longitude", "latitude"), "eva", "left")


def station_dimension(targets: DataFrame, master: DataFrame, manual: DataFrame) -> DataFrame:
    """Poll targets with coordinates from the master data, else by hand, else missing."""
    found = master.select("eva", F.col("latitude").alias("master_latitude"),
                          F.col("longitude").alias("master_longitude"))
    joined = targets.drop("latitude", "longitude") \
        .join(found, "eva", "left").join(manual, "eva", "left")
    in_master = F.col("master_latitude").isNotNull() & F.col("master_longitude").isNotNull()
    by_hand = F.col("manual_latitude").isNotNull()

    def pick(name: str):
        return F.when(in_master, F.col(f"master_{name}")).otherwise(F.col(f"manual_{name}"))

    return joined.select(
        F.col("eva").alias("station_eva"), F.col("name").alias("station_name"), "stada_name",
        pick("latitude").alias("latitude"), pick("longitude").alias("longitude"),
        F.when(in_master, F.lit("stada")).when(by_hand, F.lit("manual"))
        .otherwise(F.lit("missing")).alias("coordinate_source"),
        "category", "federal_state", "route_calls",
    )
