"""Profile of a realtime feed, from flattened rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import share

# How many causes, effects and texts an alert profile lists.
TOP_VALUES = 5
TOP_TEXTS = 3


def is_present(df: DataFrame, name: str) -> Column:
    """Set and, for texts, not empty."""
    field = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(field != "", F.lit(False))
    return field.isNotNull()


def field_presence(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, present, total, pct), all fields from one pass over the rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_present(df, name)).alias(name) for name in fields])
    entries = F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(f"`{name}`").alias("present"))
        for name in fields])
    return counts.select("total", F.explode(entries).alias("entry")).select(
        "entry.field", "entry.present", "total",
        share(F.col("entry.present"), F.col("total")).alias("pct"))


def identity_profile(trip_updates: DataFrame) -> DataFrame:
    """How far trip ids identify a run, and the trips per start date.

    Counted per (id, date) first, then per id and per date. `start_dates` holds `date=trips`,
    one entry per day of the feed, in order.
    """
    pairs = trip_updates.groupBy("trip_id", "start_date").agg(F.count(F.lit(1)).alias("rows"))
    ids = pairs.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("dates"), F.sum("rows").alias("rows"))
    days = pairs.groupBy("start_date").agg(F.sum("rows").alias("rows"))
    entry = F.concat_ws("=", F.coalesce("start_date", F.lit("")), F.col("rows"))
    return ids.agg(
        F.count(F.lit(1)).alias("unique_trip_ids"),
        F.coalesce(F.sum("dates"), F.lit(0)).alias("unique_pairs"),
        F.count_if(F.col("dates") > 1).alias("ids_on_several_dates"),
        F.count_if(F.col("rows") > 1).alias("ids_repeated"),
    ).withColumn("start_dates", days.agg(F.array_sort(F.collect_list(entry))).scalar())


def alert_profile(alerts: DataFrame, top_values: int = TOP_VALUES,
                  top_texts: int = TOP_TEXTS) -> DataFrame:
    """(section, label, n, pct): every presence flag with its share of the alerts, every kind
    of selector, the most frequent causes, effects, severities and texts, and the number of
    different texts. `pct` is NULL outside the presence section.

    All sections are counted in one pass: every alert unfolds into the labels it has. A
    selector with an empty trip id names a trip without id; NULL names no trip.
    """
    def item(section: str, label: Column, times: Column | int = 1) -> Column:
        times = F.lit(times) if isinstance(times, int) else times
        return F.struct(F.lit(section).alias("section"), label.alias("label"),
                        times.cast("long").alias("times"))

    def flag(column: str) -> Column:            # also counts the alerts that lack it
        return item("presence", F.lit(column), F.coalesce(F.col(column), F.lit(False))
                    .cast("int"))

    def selectors(entity: Column) -> Column:
        given = [F.when(F.coalesce(entity[name] != "", F.lit(False)),
                        item("selector", F.lit(name)))
                 for name in ("agency_id", "route_id", "stop_id", "trip_id")]
        return F.array(*given, F.when(entity["trip_id"] == "",
                                      item("selector", F.lit("trip without id"))))

    own = F.array(
        *[flag(c) for c in ("has_informed_entity", "has_active_period", "has_header",
                            "has_description", "has_url")],
        *[item(c, F.col(c)) for c in ("cause", "effect", "severity")])
    none = F.array().cast("array<struct<section:string,label:string,times:bigint>>")
    items = F.concat(
        own,
        F.coalesce(F.flatten(F.transform("entities", selectors)), none),
        F.coalesce(F.transform("texts", lambda t: item("text", t)), none))
    counts = (
        alerts.select(F.explode(F.filter(items, lambda i: i.isNotNull())).alias("i"))
        .groupBy(F.col("i.section").alias("section"), F.col("i.label").alias("label"))
        .agg(F.sum("i.times").alias("n"), F.count(F.lit(1)).alias("total"))
    )
    # Presence and selectors have a few labels each and are listed whole. The others are ranked
    # behind a plain limit, which every task applies before the shuffle, so that no task meets
    # all different texts.
    few = F.col("section").isin("presence", "selector")
    rank = F.row_number().over(
        Window.partitionBy("section").orderBy(F.col("n").desc(), F.col("label")))
    ranked = counts.filter(~few).withColumn("rank", rank).filter(
        F.col("rank") <= max(top_values, top_texts))
    most = F.when(F.col("section") == "text", top_texts).otherwise(top_values)
    listed = counts.filter(few).select(
        "section", "label", "n",
        F.when(F.col("section") == "presence", share(F.col("n"), F.col("total"))).alias("pct")
    ).unionByName(ranked.filter(F.col("rank") <= most).select(
        "section", "label", "n", F.lit(None).cast("double").alias("pct")))
    different = counts.filter("section = 'text'").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("distinct_texts").alias("section"), F.lit("").alias("label"), "n",
        F.lit(None).cast("double").alias("pct"))
    return listed.unionByName(different)
