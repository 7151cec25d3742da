"""Top lists, unions, set operations, scalar subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ranks import most_common
from ..operators.stacking import stack
from ..plans import gold
from ..sources import frames
from .derived import segments, stops, trips
from .oracle import rounded, using
from .registry import query


@query("most_common", using("f", body="""
SELECT station_name AS value, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, value LIMIT 10
"""))
def _most_common(spark, sf):
    return most_common(frames.observations(spark, sf), "station_name", 10)


@query("topk_routes", using("trips", body=f"""
SELECT origin, destination, count(*) AS trips,
  {rounded("avg(arrival_delay_at_last_observed)", 1)} AS avg_delay
FROM trips WHERE is_long_distance AND origin IS NOT NULL
GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY trips DESC, origin, destination LIMIT 20
"""))
def _topk_routes(spark, sf):
    return gold.top_routes(trips(spark, sf))


@query("topk_routes_all", using("trips", body=f"""
SELECT origin, destination, count(*) AS trips,
  {rounded("avg(observed_stop_count)", 1)} AS avg_stops_observed,
  {rounded("avg(arrival_delay_at_last_observed)", 1)} AS avg_delay_min
FROM trips GROUP BY 1, 2
ORDER BY trips DESC, origin NULLS FIRST, destination NULLS FIRST LIMIT 20
"""))
def _topk_routes_all(spark, sf):
    return gold.sample_routes(trips(spark, sf))


@query("topk_segments", using("segments", body="""
SELECT from_station, to_station, trips, avg_delay_gained_minutes, avg_planned_minutes
FROM segments WHERE hops = 1 AND trips >= 5
ORDER BY avg_delay_gained_minutes DESC, from_station, to_station LIMIT 15
"""))
def _topk_segments(spark, sf):
    return gold.top_segments(gold.segment_table(stops(spark, sf)))


@query("topk_pairs", using("pairs", body="""
SELECT from_station, to_station, direct_trains, avg_arrival_delay_minutes,
  median_arrival_delay_minutes, p90_arrival_delay_minutes, pct_within_5_min,
  avg_planned_journey_minutes
FROM pairs WHERE direct_trains >= 5
ORDER BY direct_trains DESC, from_station, to_station LIMIT 15
"""))
def _topk_pairs(spark, sf):
    return gold.top_pairs(gold.station_pair_table(stops(spark, sf)))


@query("union_all", using("stops", body="""
SELECT 'observations' AS scope, train_category, count(*) AS n FROM f GROUP BY 2
UNION ALL SELECT 'stops', train_category, count(*) FROM stops GROUP BY 2
"""))
def _union_all(spark, sf):
    def counted(scope, df):
        return df.groupBy("train_category").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(scope).alias("scope"), "train_category", "n")

    return stack([counted("observations", frames.observations(spark, sf)),
                  counted("stops", stops(spark, sf))])


def _id_sets(spark, sf):
    delayed = frames.observations(spark, sf).filter("arrival_delay_minutes > 30")
    cancelled = frames.observations(spark, sf).filter("is_cancelled")
    return delayed.select("trip_id"), cancelled.select("trip_id")


@query("set_intersect", using("f", body="""
SELECT trip_id FROM f WHERE arrival_delay_minutes > 30
INTERSECT SELECT trip_id FROM f WHERE is_cancelled
"""))
def _set_intersect(spark, sf):
    """Trips with both a late and a cancelled stop."""
    delayed, cancelled = _id_sets(spark, sf)
    return delayed.intersect(cancelled)


@query("set_except", using("f", body="""
SELECT trip_id FROM f WHERE arrival_delay_minutes > 30
EXCEPT SELECT trip_id FROM f WHERE is_cancelled
"""))
def _set_except(spark, sf):
    """Trips with a late stop and no cancelled one."""
    delayed, cancelled = _id_sets(spark, sf)
    return delayed.subtract(cancelled)


@query("select_distinct", using("consecutive", body="""
SELECT DISTINCT from_station, to_station FROM consecutive WHERE hops = 1
"""))
def _select_distinct(spark, sf):
    return gold.consecutive_stops(stops(spark, sf)).filter("hops = 1") \
        .select("from_station", "to_station").distinct()


@query("scalar_subquery", using("segments", body="""
SELECT (SELECT count(*) FROM f) AS observations, (SELECT count(DISTINCT stop_id) FROM f) AS stops,
  (SELECT count(*) FROM segments WHERE hops = 1) AS adjacent_segments,
  CASE WHEN (SELECT count(*) FROM stops) = (SELECT count(DISTINCT stop_id) FROM f)
    THEN 'PASS' ELSE 'FAIL' END AS status
"""))
def _scalar_subquery(spark, sf):
    """Independent numbers in one row."""
    observed = frames.observations(spark, sf)
    one = F.count(F.lit(1))
    adjacent = segments(spark, sf).filter("hops = 1").agg(one).scalar()
    gold_rows = stops(spark, sf).agg(one).scalar()
    return observed.agg(one.alias("observations"), F.count_distinct("stop_id").alias("stops")) \
        .select("observations", "stops", adjacent.alias("adjacent_segments"),
                F.when(gold_rows == F.col("stops"), F.lit("PASS")).otherwise(F.lit("FAIL"))
                .alias("status"))
