"""Timetable documents to observations: plan join, scope, counters, worklist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import (
    content_digest,
    in_scope,
    is_strict_long_distance,
    share,
    split_stop_id,
)
from ..functions.times import BERLIN
from ..session import require_utc
from ..sources.documents import change_stops, parsed

# The plan window in hours around now; offsets that are always read again.
PLAN_HOURS_BACK = 9
PLAN_HOURS_FORWARD = 8
ALWAYS_REFETCHED = [0, 1]
# Days for which read plan hours and plan entries are kept.
KEEP_DAYS = 2


def with_stop_key(changes: DataFrame) -> DataFrame:
    """Split the stop id; rows whose id is missing or does not parse are skipped."""
    trip, start, index = split_stop_id(F.col("stop_id"))
    keyed = changes.withColumns(
        {"trip_id": trip, "start_datetime": start, "stop_index": index})
    return keyed.filter("stop_index IS NOT NULL")


def join_plan(changes: DataFrame, plan: DataFrame) -> DataFrame:
    """Changes with the planned values of their stop; changes without a plan are kept.

    `plan` has one row per stop id (`latest.latest_plan`).
    """
    return changes.join(plan.select("stop_id", *S.PLAN_FIELDS), "stop_id", "left")


def _identified(changes: DataFrame, plan: DataFrame, only_long_distance: bool) -> DataFrame:
    joined = join_plan(with_stop_key(changes), plan)
    return joined.filter(in_scope(F.col("train_filter"))) if only_long_distance else joined


def _payload() -> list[Column]:
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.PAYLOAD]


def observations(changes: DataFrame, plan: DataFrame, *, only_long_distance: bool = True
                 ) -> DataFrame:
    """Change stops of a poll -> observations in payload form.

    `changes` carries station_eva, station_name and observed_at of the poll.
    """
    return _identified(changes, plan, only_long_distance).select(*_payload())


def poll_rows(documents: DataFrame, plan: DataFrame, *, only_long_distance: bool = True
              ) -> DataFrame:
    """Change documents of numbered polls -> observations, ready for the change filter.

    `documents` carries document, station_eva, station_name, observed_at and cycle. Works on
    a stream: the plan is a table at rest.
    """
    return _identified(change_stops(documents), plan, only_long_distance).select(
        F.col("stop_id").alias("key"), F.col("cycle").cast("int").alias("cycle"),
        F.col("position").cast("long").alias("position"), content_digest().alias("digest"),
        *_payload())


def strict_long_distance(observed: DataFrame) -> DataFrame:
    return observed.filter(is_strict_long_distance(F.col("train_filter")))


def poll_counters(changes: DataFrame, plan: DataFrame, group: str) -> DataFrame:
    """Changed, identified, unidentified and kept stops per group (a cycle or a station).

    All are counted before the scope filter, except the kept ones.
    """
    _, _, index = split_stop_id(F.col("stop_id"))
    joined = join_plan(changes.withColumn("stop_index", index), plan)
    sound = F.col("stop_index").isNotNull()
    known = F.col("train_category").isNotNull()
    return joined.groupBy(group).agg(
        F.count(F.lit(1)).alias("changed_stops"),
        F.count_if(sound & known).alias("identified"),
        F.count_if(sound & ~known).alias("unidentified"),
        F.count_if(sound & in_scope(F.col("train_filter"))).alias("observations"),
    )


def poll_outcomes(documents: DataFrame, group: str, column: str = "document") -> DataFrame:
    """Stations whose change document came in, and those that failed, per group."""
    tested = parsed(documents.select(group, column), S.CHANGE_DOCUMENT, column)
    return tested.groupBy(group).agg(
        F.count_if(~F.col("failed")).alias("stations_polled"),
        F.count_if("failed").alias("stations_failed"))


def match_rate(changes: DataFrame, plan: DataFrame) -> DataFrame:
    """How many changes meet a plan, in one pass."""
    flagged = changes.select("stop_id").join(
        plan.select("stop_id", F.lit(True).alias("planned")), "stop_id", "left")
    counts = flagged.agg(
        F.count_if(F.col("planned")).alias("matched"),
        F.count_if(F.col("planned").isNull()).alias("unmatched"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.withColumn("pct_matched", share(F.col("matched"), F.col("total")))


def _berlin_hour(now: Column, hours: Column) -> Column:
    """The local hour `hours` after the one of the instant `now`, as YYMMDDHH.

    Hours are counted on the local clock, as the timetable is: after the change in spring
    there is an hour without trains, and none is read twice in autumn.
    """
    local = F.from_utc_timestamp(now, BERLIN)
    return F.date_format(F.timestamp_seconds(F.unix_timestamp(local) + hours * 3600), "yyMMddHH")


def recent_slots(fetched: DataFrame, now: Column, keep_days: int = KEEP_DAYS) -> DataFrame:
    """The fetched plan hours (eva, slot) worth remembering; the list would only grow."""
    first = F.substring(_berlin_hour(now, F.lit(-24 * keep_days)), 1, 6)
    return fetched.filter(F.substring("slot", 1, 6) >= first)


def plan_worklist(stations: DataFrame, now: Column, fetched: DataFrame) -> DataFrame:
    """Plan hours to read: the window around the instant `now`, without hours read before.

    The current and the next hour can still gain entries and are always read. Each station
    unfolds into its 18 hours; `fetched` is (eva, slot) with slot YYMMDDHH in Berlin time.
    """
    require_utc(stations.sparkSession)
    hours = F.sequence(F.lit(-PLAN_HOURS_BACK), F.lit(PLAN_HOURS_FORWARD))
    slots = stations.select("eva", F.explode(hours).alias("offset")).withColumn(
        "slot", _berlin_hour(now, F.col("offset")))
    known = fetched.select("eva", "slot").distinct().withColumn("known", F.lit(True))
    return (
        slots.join(known, ["eva", "slot"], "left")
        .filter(F.col("known").isNull() | F.col("offset").isin(ALWAYS_REFETCHED))
        .drop("known")
    )
