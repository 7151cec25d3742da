"""Aggregates and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import percentile_array, share
from ..operators.changes import changed_since_previous, cycle_counters
from ..operators.ranks import discrete_quantiles, most_common, value_counts
from ..operators.reconcile import stop_sequences
from ..plans import checks, feed, geometry as geo, gold, stations as station_plans, timetable
from ..sources import frames
from .derived import geometry, last, polls, segments, stops, trips
from .oracle import count_if, joined, pct, rounded, using
from .registry import query


@query("percentiles", using("f", body="""
SELECT train_category, count(*) AS observations,
  cast(quantile_disc(arrival_delay_minutes, 0.5) AS double) AS median,
  cast(quantile_disc(arrival_delay_minutes, 0.9) AS double) AS p90,
  cast(quantile_disc(arrival_delay_minutes, 0.95) AS double) AS p95
FROM f GROUP BY train_category
"""))
def _percentiles(spark, sf):
    p = percentile_array("arrival_delay_minutes", [0.5, 0.9, 0.95])
    return frames.observations(spark, sf).groupBy("train_category").agg(
        F.count(F.lit(1)).alias("observations"), p.alias("p")).select(
        "train_category", "observations",
        *[F.get("p", F.lit(i)).cast("double").alias(n)
          for i, n in enumerate(("median", "p90", "p95"))])


@query("global_agg", using("stops", body=f"""
SELECT count(*) AS stops, {count_if("is_cancelled")} AS cancelled,
  {rounded("avg(arrival_delay_minutes)", 1)} AS avg_arrival_delay,
  cast(sum(departure_delay_minutes) AS bigint) AS departure_delay_sum,
  {rounded(pct("count(*) FILTER (WHERE origin IS NOT NULL)", "count(*)"), 1)} AS pct_with_route
FROM stops
"""))
def _global_agg(spark, sf):
    return stops(spark, sf).agg(
        F.count(F.lit(1)).alias("stops"), F.count_if("is_cancelled").alias("cancelled"),
        F.round(F.avg("arrival_delay_minutes"), 1).alias("avg_arrival_delay"),
        F.sum("departure_delay_minutes").alias("departure_delay_sum"),
        F.round(share(F.count("origin"), F.count(F.lit(1))), 1).alias("pct_with_route"))


@query("mode_value", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS start_date, count(*) AS trips
FROM orders GROUP BY 1 ORDER BY trips DESC, start_date LIMIT 1
""")
def _mode_value(spark, sf):
    """The most common start date; the earlier one of equals."""
    dates = frames.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return most_common(dates, "d", 1).select(
        F.col("value").alias("start_date"), F.col("n").alias("trips"))


ALERT_SQL = """
WITH alerts AS (
  SELECT event_type AS cause, concat('E', user_id % 4) AS effect,
    concat('V', user_id % 3) AS severity, event_id % 2 = 0 AS has_informed_entity,
    event_id % 3 = 0 AS has_active_period, event_id % 5 = 0 AS has_header,
    event_id % 11 <> 0 AS has_description, false AS has_url, event_id, user_id FROM events),
presence AS (
  SELECT 'presence' AS section, label, count(*) FILTER (WHERE given) AS n,
    100 * cast(count(*) FILTER (WHERE given) AS double) / count(*) AS pct
  FROM (UNPIVOT (SELECT has_informed_entity, has_active_period, has_header, has_description,
    has_url FROM alerts) ON COLUMNS(*) INTO NAME label VALUE given) GROUP BY label),
selectors AS (
  SELECT 'selector' AS section, unnest([CASE WHEN user_id % 4 = 0 THEN 'agency_id' END,
    CASE WHEN user_id % 5 = 0 THEN 'trip without id' ELSE 'trip_id' END]) AS label
  FROM alerts WHERE has_informed_entity),
counts AS (
  SELECT section, label, count(*) AS n FROM (
    SELECT 'cause' AS section, cause AS label FROM alerts
    UNION ALL SELECT 'effect', effect FROM alerts
    UNION ALL SELECT 'severity', severity FROM alerts
    UNION ALL SELECT 'text', concat('T', event_id % 7) FROM alerts WHERE has_description)
  GROUP BY 1, 2)
SELECT section, label, n, pct FROM presence
UNION ALL
SELECT section, label, count(*), NULL FROM selectors WHERE label IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT section, label, n, NULL FROM (
  SELECT *, row_number() OVER (PARTITION BY section ORDER BY n DESC, label) AS rank FROM counts)
WHERE rank <= CASE WHEN section = 'text' THEN 3 ELSE 5 END
UNION ALL SELECT 'distinct_texts', '', count(*), NULL FROM counts WHERE section = 'text'
"""


@query("alert_profile", ALERT_SQL)
def _alert_profile(spark, sf):
    """Every event as an alert."""
    e, u = F.col("event_id"), F.col("user_id")
    none = F.lit(None).cast("string")
    entity = F.struct(
        F.when(u % 4 == 0, F.concat(F.lit("A"), u)).otherwise(F.lit("")).alias("agency_id"),
        none.alias("route_id"), none.alias("stop_id"),
        F.when(u % 5 == 0, "").otherwise(u.cast("string")).alias("trip_id"))
    no_entities = F.array().cast(
        "array<struct<agency_id:string,route_id:string,stop_id:string,trip_id:string>>")
    alerts = frames.table(spark, sf, "events").select(
        F.col("event_type").alias("cause"), F.concat(F.lit("E"), u % 4).alias("effect"),
        F.concat(F.lit("V"), u % 3).alias("severity"),
        (e % 2 == 0).alias("has_informed_entity"), (e % 3 == 0).alias("has_active_period"),
        (e % 5 == 0).alias("has_header"), (e % 11 != 0).alias("has_description"),
        F.lit(False).alias("has_url"),
        F.when(e % 2 == 0, F.array(entity)).otherwise(no_entities).alias("entities"),
        F.when(e % 11 != 0, F.array(F.concat(F.lit("T"), e % 7))).alias("texts"))
    return feed.alert_profile(alerts)


DAILY_SQL = f"""
SELECT service_date, origin, destination, count(*) AS trips_observed,
  avg(arrival_delay_at_last_observed) AS avg_arrival_delay_minutes,
  cast(quantile_disc(arrival_delay_at_last_observed, 0.5) AS double)
    AS median_arrival_delay_minutes,
  cast(quantile_disc(arrival_delay_at_last_observed, 0.9) AS double)
    AS p90_arrival_delay_minutes,
  cast(quantile_disc(arrival_delay_at_last_observed, 0.95) AS double)
    AS p95_arrival_delay_minutes,
  {pct("count(*) FILTER (WHERE arrival_delay_at_last_observed BETWEEN -999 AND 5)",
       "count(arrival_delay_at_last_observed)")} AS pct_within_5_min,
  {pct("count(*) FILTER (WHERE arrival_delay_at_last_observed > 15)",
       "count(arrival_delay_at_last_observed)")} AS pct_over_15_min,
  {pct("count(*) FILTER (WHERE any_stop_cancelled)", "count(*)")} AS cancellation_rate
FROM trips WHERE is_long_distance GROUP BY service_date, origin, destination
"""


@query("daily_route", using("trips", body=DAILY_SQL))
def _daily_route(spark, sf):
    return gold.daily_route_table(trips(spark, sf))


@query("daily_route_uncancelled", using("trips", body=f"""
SELECT service_date, count(*) AS groups, cast(sum(trips) AS bigint) AS trips,
  cast(sum(known) AS bigint) AS known
FROM (SELECT service_date, origin, destination, count(*) AS trips,
    count(CASE WHEN NOT any_stop_cancelled THEN arrival_delay_at_last_observed END) AS known,
    {count_if("any_stop_cancelled")} AS cancelled
  FROM trips WHERE is_long_distance GROUP BY 1, 2, 3)
WHERE known > 0 GROUP BY service_date
"""))
def _daily_route_uncancelled(spark, sf):
    """The variant without cancelled trips: days by groups that still have a delay."""
    t = trips(spark, sf)
    daily = gold.daily_route_table(t, exclude_cancelled=True)
    known = t.filter("is_long_distance AND NOT any_stop_cancelled").groupBy("service_date").agg(
        F.count("arrival_delay_at_last_observed").alias("known"))
    return daily.filter("avg_arrival_delay_minutes IS NOT NULL").groupBy("service_date").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("trips_observed").alias("trips")
    ).join(known, "service_date")


SEGMENT_COLUMNS = """from_station, to_station, hops, trips, avg_delay_gained_minutes,
  median_delay_gained_minutes, p90_delay_gained_minutes, avg_delay_at_from, avg_delay_at_to,
  avg_planned_minutes, trips_losing_time, trips_recovering_time"""


@query("segment_stats", using("segments", body=f"SELECT {SEGMENT_COLUMNS} FROM segments"))
def _segment_stats(spark, sf):
    return gold.segment_table(stops(spark, sf))


@query("station_pair_stats", using("pairs", body="SELECT * FROM pairs"))
def _station_pair_stats(spark, sf):
    return gold.station_pair_table(stops(spark, sf))


@query("having_filter", using("trips", body=f"""
SELECT origin, destination, count(*) AS trips,
  {rounded("avg(arrival_delay_at_last_observed)", 1)} AS avg_delay
FROM trips WHERE is_long_distance AND origin IS NOT NULL
GROUP BY 1, 2 HAVING count(*) >= 3
"""))
def _having_filter(spark, sf):
    return trips(spark, sf).filter("is_long_distance AND origin IS NOT NULL") \
        .groupBy("origin", "destination").agg(
            F.count(F.lit(1)).alias("trips"),
            F.round(F.avg("arrival_delay_at_last_observed"), 1).alias("avg_delay")) \
        .filter("trips >= 3")


@query("conditional_pct", using("stops", body=f"""
SELECT service_date, train_category,
  {pct("count(*) FILTER (WHERE arrival_delay_minutes <= 5)", "count(arrival_delay_minutes)")}
    AS pct_on_time,
  {pct("count(*) FILTER (WHERE is_cancelled)", "count(*)")} AS pct_cancelled
FROM stops GROUP BY service_date, train_category
"""))
def _conditional_pct(spark, sf):
    return stops(spark, sf).groupBy("service_date", "train_category").agg(
        share(F.count_if(F.col("arrival_delay_minutes") <= 5),
              F.count("arrival_delay_minutes")).alias("pct_on_time"),
        share(F.count_if("is_cancelled"), F.count(F.lit(1))).alias("pct_cancelled"))


@query("multi_col_distinct", using("stops", body="""
SELECT count(DISTINCT (trip_id, start_at, station_name)) AS trip_stations,
  count(DISTINCT CASE WHEN train_category IS NOT NULL AND origin IS NOT NULL
    THEN (train_category, origin) END) AS category_origins
FROM stops
"""))
def _multi_col_distinct(spark, sf):
    """Combinations with a NULL are not counted."""
    return stops(spark, sf).agg(
        F.count_distinct("trip_id", "start_at", "station_name").alias("trip_stations"),
        F.count_distinct("train_category", "origin").alias("category_origins"))


@query("cycle_counters", using("polls", body="""
WITH state AS (SELECT key, cycle, arg_max(content, position) AS content FROM polls GROUP BY 1, 2),
changed AS (SELECT s.key, s.cycle FROM state s LEFT JOIN state p
  ON p.key = s.key AND p.cycle = s.cycle - 1 AND p.content = s.content WHERE p.key IS NULL)
SELECT cycle, count(*) AS seen, count(c.key) AS written, count(*) - count(c.key) AS suppressed
FROM polls LEFT JOIN changed c USING (key, cycle) GROUP BY cycle
"""))
def _cycle_counters(spark, sf):
    rows = polls(spark, sf)
    return cycle_counters(rows, changed_since_previous(rows))


@query("category_rollup", """
SELECT category, n, cast(sum(n) OVER (ORDER BY category NULLS LAST) AS bigint) AS cumulative
FROM (SELECT CASE WHEN p_size % 11 <> 0 THEN cast(p_size AS bigint) END AS category, count(*) AS n
  FROM part GROUP BY 1)
""")
def _category_rollup(spark, sf):
    rated = frames.table(spark, sf, "part").select(
        F.when(F.col("p_size") % 11 != 0, F.col("p_size")).alias("category"))
    return station_plans.category_rollup(rated)


@query("discrete_quantiles", using("f", body="""
SELECT point, value FROM (
  SELECT list_sort(list(seconds)) AS v FROM (
    SELECT departure_delay_minutes * 60 + station_eva AS seconds FROM f)
  WHERE seconds IS NOT NULL), (
  SELECT unnest([0.0, 0.25, 0.5, 0.75, 0.95, 1.0])::double AS point), LATERAL (
  SELECT v[cast(floor(point * (len(v) - 1)) AS bigint) + 1] AS value)
"""))
def _discrete_quantiles(spark, sf):
    """Exact quantiles of the departure delay in seconds."""
    rows = frames.observations(spark, sf).select(
        (F.col("departure_delay_minutes") * 60 + F.col("station_eva")).alias("seconds"))
    return discrete_quantiles(rows, "seconds", [0.0, 0.25, 0.5, 0.75, 0.95, 1.0])


@query("identity_profile", """
WITH t AS (SELECT l_suppkey AS trip_id, strftime(l_shipdate, '%Y%m%d') AS start_date FROM lineitem),
ids AS (SELECT trip_id, count(DISTINCT start_date) AS dates, count(*) AS n FROM t GROUP BY 1),
days AS (SELECT start_date, count(*) AS n FROM t GROUP BY 1)
SELECT count(*) AS unique_trip_ids, cast(sum(dates) AS bigint) AS unique_pairs,
  cast(count(*) FILTER (WHERE dates > 1) AS bigint) AS ids_on_several_dates,
  cast(count(*) FILTER (WHERE n > 1) AS bigint) AS ids_repeated,
  (SELECT string_agg(concat(start_date, '=', n), ',' ORDER BY start_date) FROM days)
    AS start_dates
FROM ids
""")
def _identity_profile(spark, sf):
    updates = frames.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("trip_id"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("start_date"))
    return feed.identity_profile(updates)


@query("trip_stop_sequence", using("last_obs", body=f"""
SELECT trip_id, {joined("list(station_name ORDER BY stop_index)")} AS stops
FROM last_obs GROUP BY trip_id
"""))
def _trip_stop_sequence(spark, sf):
    return stop_sequences(last(spark, sf), order="stop_index", stop="station_name")


@query("trip_time_span", """
WITH st AS (SELECT cast(l_orderkey AS varchar) AS trip_id,
    CASE WHEN l_partkey % 4 <> 0 THEN printf('%02d:%02d:00', l_linenumber * 3 + l_orderkey % 24,
      l_partkey % 60) ELSE '' END AS departure,
    CASE WHEN l_partkey % 6 <> 0 THEN printf('%02d:%02d:00', l_linenumber * 3 + l_orderkey % 24,
      l_suppkey % 60) END AS arrival
  FROM lineitem)
SELECT trip_id, min(t) AS first_time, max(t) AS last_time
FROM (SELECT trip_id, coalesce(nullif(departure, ''), nullif(arrival, '')) AS t FROM st)
WHERE t IS NOT NULL GROUP BY trip_id
""")
def _trip_time_span(spark, sf):
    """Times beyond 24 hours included; stops without any time are skipped."""
    hour = F.col("l_linenumber") * 3 + F.col("l_orderkey") % 24
    part = F.col("l_partkey")
    stop_times = frames.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.when(part % 4 != 0, F.format_string("%02d:%02d:00", hour, part % 60))
        .otherwise(F.lit("")).alias("departure_time"),
        F.when(part % 6 != 0, F.format_string("%02d:%02d:00", hour, F.col("l_suppkey") % 60))
        .alias("arrival_time"))
    return timetable.trip_time_spans(stop_times)


PRESENCE = ["train_category", "train_filter", "brand", "changed_arrival_platform",
            "planned_path_from", "arrival_delay_minutes", "changed_departure_at"]


@query("field_presence", using("f", body=" UNION ALL ".join(
    f"SELECT '{c}' AS field, {count_if(f'cast({c} AS varchar) <> {chr(39) * 2}')} AS present, "
    f"count(*) AS total, {pct(f'count(*) FILTER (WHERE cast({c} AS varchar) <> {chr(39) * 2})', 'count(*)')}"
    f" AS pct FROM f" for c in PRESENCE)))
def _field_presence(spark, sf):
    return feed.field_presence(frames.observations(spark, sf), PRESENCE)


@query("value_counts", f"""
SELECT event_type AS value, count(*) AS n, {pct("count(*)", "(SELECT count(*) FROM events)")} AS pct
FROM events GROUP BY event_type
""")
def _value_counts(spark, sf):
    return value_counts(frames.table(spark, sf, "events"), "event_type")


@query("route_call_counts", using("f", body="""
SELECT name, count(*) AS route_calls FROM (
  SELECT unnest(list_concat(coalesce(string_split(planned_path_from, '|'), []),
    coalesce(string_split(planned_path_to, '|'), []))) AS name
  FROM f WHERE train_filter = 'F')
WHERE name <> '' GROUP BY name
"""))
def _route_call_counts(spark, sf):
    return station_plans.route_call_counts(frames.observations(spark, sf))


@query("check_grain", using("stops", body="""
SELECT 'grain' AS test, cast(count(*) - count(DISTINCT stop_id) AS bigint) AS failures,
  CASE WHEN count(*) = count(DISTINCT stop_id) THEN 'PASS' ELSE 'FAIL' END AS status FROM stops
UNION ALL
SELECT 'grain by station', count(*) - count(DISTINCT (trip_id, start_at, station_name)),
  CASE WHEN count(*) = count(DISTINCT (trip_id, start_at, station_name)) THEN 'PASS'
  ELSE 'FAIL' END FROM stops
"""))
def _check_grain(spark, sf):
    """Our rule, and the report by station, which repeated calls make fail."""
    s = stops(spark, sf)
    return checks.check_grain(s).unionByName(checks.grain_by_station(s))


@query("check_trip_length", using("stops", body="""
SELECT 'trip length' AS test, count(*) AS failures,
  CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT trip_id, start_at FROM stops GROUP BY 1, 2 HAVING count(*) > 1000)
"""))
def _check_trip_length(spark, sf):
    return checks.check_trip_length(stops(spark, sf))


@query("check_collapse", using("stops", body="""
SELECT 'collapse' AS test, abs(g - d) AS failures,
  CASE WHEN g = d THEN 'PASS' ELSE 'FAIL' END AS status,
  format('Silver: {:,} obs, {:,} stops -> Gold: {:,} rows', n, d, g) AS detail
FROM (SELECT (SELECT count(*) FROM f) AS n, (SELECT count(DISTINCT stop_id) FROM f) AS d,
  (SELECT count(*) FROM stops) AS g)
"""))
def _check_collapse(spark, sf):
    return checks.check_collapse(frames.observations(spark, sf), stops(spark, sf))


@query("check_null_preserved", using("stops", body="""
SELECT 'null preserved' AS test, count(*) AS failures,
  CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM stops WHERE changed_arrival_at IS NULL AND arrival_delay_minutes IS NOT NULL
"""))
def _check_null_preserved(spark, sf):
    return checks.check_null_preserved(stops(spark, sf))


@query("check_circular", using("stops", body=f"""
SELECT {count_if("origin IS NULL")} AS null_origin,
  {count_if("origin = destination")} AS still_circular,
  {rounded(pct("count(origin)", "count(*)"), 1)} AS pct_with_route,
  {rounded(pct("count(*) FILTER (WHERE is_long_distance AND origin IS NOT NULL)",
               "count(*) FILTER (WHERE is_long_distance)"), 1)} AS pct_with_route_long_distance
FROM stops
"""))
def _check_circular(spark, sf):
    return checks.check_circular(stops(spark, sf))


@query("check_station_coords", using("stations", body="""
SELECT station_eva, station_name FROM stations WHERE latitude IS NULL
"""))
def _check_station_coords(spark, sf):
    return checks.check_station_coords(frames.stations(spark, sf))


def _scenario(name: str, origin: str, table: str) -> str:
    return f"""SELECT '{name}' AS scenario, count(*) AS total_rows,
      {count_if(f"({origin}) IS NULL")} AS null_origins,
      {rounded(pct(f"count({origin})", "count(*)"), 1)} AS pct_with_route FROM {table}"""


@query("route_coverage", using("stops", body=" UNION ALL ".join([
    _scenario("before: concat with NULLs",
              "CASE WHEN path_from IS NOT NULL AND path_to IS NOT NULL "
              "THEN list_concat(path_from, [station_name])[1] END", "last_obs"),
    _scenario("stop''s own route", "CASE WHEN len(route) >= 2 THEN route[1] END", "base"),
    _scenario("after: with propagation", "origin", "stops"),
])))
def _route_coverage(spark, sf):
    return checks.route_coverage(frames.observations(spark, sf), stops(spark, sf))


@query("geometry_summary", using("geometry", "segments", body=f"""
WITH sg AS (SELECT g.* FROM geometry g JOIN segments s ON s.from_station = g.from_station
  AND s.to_station = g.to_station AND s.hops = 1)
SELECT count(*) AS segments_with_geometry, {rounded("avg(len(coordinates))", 0)} AS avg_raw_points,
  {rounded("sum(track_km)", 0)} AS total_track_km,
  cast(coalesce(sum(len(list_filter(coordinates, lambda p, i: (i - 1) % greatest(1,
    cast(floor(len(coordinates) / 60) AS bigint)) = 0))), 0) AS bigint) AS map_points
FROM sg
"""))
def _geometry_summary(spark, sf):
    tracks = geometry(spark, sf).withColumn("track_km", F.round(F.col("metres") / 1000, 1))
    joined_tracks = geo.segment_geometry_table(tracks, segments(spark, sf))
    return geo.geometry_summary(joined_tracks, geo.geometry_points_table(joined_tracks))
