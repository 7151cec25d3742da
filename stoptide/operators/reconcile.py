"""Compare two sets of ids, and two sets of ordered sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import share


def id_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per id with flags for the sides it occurs on; one shuffle, pre-aggregated."""
    sides = left.select(key, F.lit(True).alias("in_left"), F.lit(False).alias("in_right")) \
        .unionByName(
            right.select(key, F.lit(False).alias("in_left"), F.lit(True).alias("in_right")))
    return sides.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))


def reconcile_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of ids in both, only left, only right, and the shares of each side."""
    both = F.col("in_left") & F.col("in_right")
    counts = id_sides(left, right, key).agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("in_left") & ~F.col("in_right")).alias("only_left"),
        F.count_if(~F.col("in_left") & F.col("in_right")).alias("only_right"),
    )
    return counts.select(
        "*",
        share(F.col("matched"), F.col("matched") + F.col("only_left")).alias("pct_of_left"),
        share(F.col("matched"), F.col("matched") + F.col("only_right")).alias("pct_of_right"),
    )


def stop_sequences(rows: DataFrame, trip: str = "trip_id", order: str = "stop_sequence",
                   stop: str = "stop_id") -> DataFrame:
    """The ordered stops of each trip as one array.

    The array is the result, one per trip and as long as the trip: its length is bounded by
    the distinct positions, because (trip, position) is the key of a timetable. Repeated rows
    of one position have to be collapsed before (`latest_row`).
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(stop))))
    return rows.groupBy(trip).agg(F.transform(pairs, lambda p: p[stop]).alias("stops"))


def sequence_class(left: Column, right: Column) -> Column:
    """exact, subset (one side's stops all occur on the other), disjoint, else other."""
    filled = (F.size(left) > 0) & (F.size(right) > 0)
    inside = (F.size(F.array_except(left, right)) == 0) | (
        F.size(F.array_except(right, left)) == 0)
    return (
        F.when(left == right, F.lit("exact"))
        .when(filled & inside, F.lit("subset"))
        .when(~F.arrays_overlap(left, right), F.lit("disjoint"))
        .otherwise(F.lit("other"))
    )


def fingerprint_matches(unmatched: DataFrame, known: DataFrame) -> DataFrame:
    """Trips of `unmatched` whose whole stop sequence is that of some trip in `known`."""
    return unmatched.join(known.select("stops").distinct(), "stops", "left_semi")
