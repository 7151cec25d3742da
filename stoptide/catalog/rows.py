"""Latest rows, neighbours along a trip, and first matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import usable_length
from ..operators.latest import first_with_count, latest_plan, main_eva
from ..plans import gold
from ..sources import frames
from .derived import last, stops, trips
from .oracle import joined, text, using
from .registry import query


@query("last_obs", using("last_obs", body=f"""
SELECT stop_id, {text("observed_at")} AS observed_at, kafka_offset, station_name,
  arrival_delay_minutes, departure_delay_minutes FROM last_obs
"""))
def _last_obs(spark, sf):
    return last(spark, sf).select("stop_id", "observed_at", "kafka_offset", "station_name",
                                  "arrival_delay_minutes", "departure_delay_minutes")


STOP_COLUMNS = [
    "stop_id", "trip_id", "start_at", "train_category", "train_number", "train_operator",
    "train_brand", "station_eva", "station_name", "stop_index", "full_route", "origin",
    "destination", "planned_arrival_at", "changed_arrival_at", "planned_departure_at",
    "changed_departure_at", "arrival_delay_minutes", "departure_delay_minutes",
    "is_cancelled", "service_date", "observed_at", "is_long_distance",
    "delay_change_vs_previous_observed_stop",
]
_STAMPS = {"start_at", "planned_arrival_at", "changed_arrival_at", "planned_departure_at",
           "changed_departure_at", "observed_at"}


def _sql(column: str) -> str:
    if column in _STAMPS or column.startswith(("first_observed_p", "first_observed_a",
                                               "last_observed_p", "last_observed_a")):
        return f"{text(column)} AS {column}"
    return f"{joined(column)} AS {column}" if column == "full_route" else column


@query("delay_delta", using("stops", body=f"""
SELECT {', '.join(_sql(c) for c in STOP_COLUMNS)} FROM stops
"""))
def _delay_delta(spark, sf):
    """The whole stop table; its last column is the change against the previous stop."""
    return stops(spark, sf).select(*STOP_COLUMNS)


@query("route_propagate", using("stops", body=f"""
SELECT stop_id, {joined("full_route")} AS full_route,
  CASE WHEN len(full_route) >= 2 THEN cast(len(full_route) AS bigint) ELSE 0 END AS usable,
  origin, destination FROM stops
"""))
def _route_propagate(spark, sf):
    return stops(spark, sf).select("stop_id", "full_route",
                                   usable_length(F.col("full_route")).alias("usable"),
                                   "origin", "destination")


TRIP_COLUMNS = [
    "trip_id", "start_at", "train_category", "train_number", "train_operator", "train_brand",
    "origin", "destination", "service_date", "is_long_distance",
    "first_observed_station", "first_observed_planned_departure",
    "first_observed_actual_departure", "departure_delay_at_first_observed",
    "last_observed_station", "last_observed_planned_arrival", "last_observed_actual_arrival",
    "arrival_delay_at_last_observed", "delay_change_over_observed_span",
    "observed_stop_count", "any_stop_cancelled",
]


@query("trip_endpoints", using("trips", body=f"""
SELECT {', '.join(_sql(c) for c in TRIP_COLUMNS)} FROM trips
"""))
def _trip_endpoints(spark, sf):
    """The whole trip table."""
    return trips(spark, sf).select(*TRIP_COLUMNS)


@query("segment_lag", using("consecutive", body="""
SELECT trip_id, from_station, to_station, hops, delay_gained, delay_at_from, delay_at_to,
  cast(planned_minutes AS double) AS planned_minutes, either_cancelled
FROM consecutive
"""))
def _segment_lag(spark, sf):
    return gold.consecutive_stops(stops(spark, sf)).drop("start_at")


@query("plan_latest", using("f", body=f"""
SELECT stop_id, station_name, train_category, {text("observed_at")} AS fetched_at
FROM (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY observed_at DESC) AS rn
  FROM f WHERE substr(strftime(start_at, '%y%m%d%H%M'), 1, 6) >= '930615')
WHERE rn = 1
"""))
def _plan_latest(spark, sf):
    """A later plan fetch wins; trips that began before 15 June 1993 are dropped."""
    fetched = frames.observations(spark, sf).select(
        "stop_id", "station_name", "train_category", F.col("observed_at").alias("fetched_at"))
    return latest_plan(fetched, cutoff=F.lit("930615"))


@query("first_valid_candidate", """
WITH counts AS (
  SELECT l_suppkey AS eva, count(*) AS calls FROM lineitem GROUP BY 1),
tried AS (
  SELECT p_partkey, unnest([p_partkey, p_partkey * 7 % 150, p_partkey % 9]) AS eva,
    unnest([0, 1, 2]) AS position
  FROM part)
SELECT concat('P', p_partkey) AS name, eva, calls, cast(position AS bigint) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY position) AS rn
  FROM tried JOIN counts USING (eva))
WHERE rn = 1
""")
def _first_valid_candidate(spark, sf):
    """Three candidate numbers per part; most parts' first number is no supplier."""
    key = F.col("p_partkey")
    candidates = frames.table(spark, sf, "part").select(
        F.concat(F.lit("P"), key).alias("name"),
        F.array(key, key * 7 % 150, key % 9).alias("candidates"))
    counts = frames.table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("eva")).agg(F.count(F.lit(1)).alias("calls"))
    return first_with_count(candidates, counts)


@query("main_eva", """
SELECT s_suppkey AS station, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey + 1000
  WHEN s_suppkey % 2 = 0 THEN s_suppkey + 2000 END AS main_eva
FROM supplier
""")
def _main_eva(spark, sf):
    key = F.col("s_suppkey")

    def entry(offset: int, is_main):
        return F.struct((key + offset).alias("number"), is_main.alias("isMain"))

    numbers = F.array(entry(0, F.lit(False)), entry(1000, key % 3 == 0),
                      entry(2000, key % 2 == 0))
    return frames.table(spark, sf, "supplier").select(
        key.alias("station"), main_eva(numbers).alias("main_eva"))
