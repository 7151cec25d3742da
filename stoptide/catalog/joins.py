"""Joins: plan, stations, timetable, reconciliation, change filter, worklists."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.changes import changed_since_previous
from ..operators.latest import last_observation
from ..operators.reconcile import fingerprint_matches, reconcile_ids, stop_sequences
from ..plans import geometry as geo
from ..plans import gold, ingest, timetable
from ..plans import stations as station_plans
from ..sources import files, frames
from .derived import geometry, last, polls, segments, stops
from .oracle import count_if, pct, text, using
from .registry import query


def plan_and_changes(spark, sf):
    """Every tenth trip has no plan; every stop changes as often as it was observed."""
    payload = frames.payloads(spark, sf)
    typed = payload.withColumn("observed_at", F.try_to_timestamp("observed_at"))
    plan = last_observation(typed).filter("cast(trip_id AS bigint) % 10 <> 0").select(
        "stop_id", *S.PLAN_FIELDS)
    changes = payload.select(
        "stop_id", "station_eva", "station_name", "observed_at", "brand", *S.CHANGE_FIELDS)
    return plan, changes


_PLAN_SQL = """
WITH plan AS (SELECT stop_id, train_category, train_filter,
    strftime(planned_arrival_at, '%y%m%d%H%M') AS planned_arrival
  FROM last_obs WHERE l_orderkey % 10 <> 0)
"""


@query("join_plan_change", using("last_obs", body=_PLAN_SQL + f"""
SELECT f.stop_id, {text("f.observed_at")} AS observed_at, p.train_category, p.planned_arrival,
  strftime(f.changed_arrival_at, '%y%m%d%H%M') AS changed_arrival
FROM f LEFT JOIN plan p USING (stop_id)
"""))
def _join_plan_change(spark, sf):
    plan, changes = plan_and_changes(spark, sf)
    return ingest.join_plan(changes, plan).select(
        "stop_id", F.regexp_replace(F.substring("observed_at", 1, 19), "T", " ")
        .alias("observed_at"), "train_category", "planned_arrival", "changed_arrival")


@query("poll_observations", using("last_obs", body=_PLAN_SQL + f"""
SELECT f.stop_id, {text("f.observed_at")} AS observed_at, f.trip_id, f.stop_index,
  p.train_category, p.train_filter, f.brand
FROM f LEFT JOIN plan p USING (stop_id) WHERE p.train_filter IS NULL OR p.train_filter = 'F'
"""))
def _poll_observations(spark, sf):
    """Plan join, stop key and scope in one: what a poll hands to the change filter."""
    plan, changes = plan_and_changes(spark, sf)
    return ingest.observations(changes, plan).select(
        "stop_id", F.regexp_replace(F.substring("observed_at", 1, 19), "T", " ")
        .alias("observed_at"), "trip_id", "stop_index", "train_category", "train_filter",
        "brand")


@query("poll_counters", using("last_obs", body=_PLAN_SQL + f"""
SELECT station_eva, count(*) AS changed_stops,
  {count_if("p.train_category IS NOT NULL")} AS identified,
  {count_if("p.train_category IS NULL")} AS unidentified,
  {count_if("p.train_filter IS NULL OR p.train_filter = 'F'")} AS observations
FROM f LEFT JOIN plan p USING (stop_id) GROUP BY station_eva
"""))
def _poll_counters(spark, sf):
    plan, changes = plan_and_changes(spark, sf)
    return ingest.poll_counters(changes, plan, "station_eva")


@query("join_match_rate", using("last_obs", body=_PLAN_SQL + f"""
SELECT {count_if("p.stop_id IS NOT NULL")} AS matched, {count_if("p.stop_id IS NULL")} AS unmatched,
  count(*) AS total, {pct("count(p.stop_id)", "count(*)")} AS pct_matched
FROM f LEFT JOIN plan p USING (stop_id)
"""))
def _join_match_rate(spark, sf):
    plan, changes = plan_and_changes(spark, sf)
    return ingest.match_rate(changes, plan)


@query("join_station_coords", using("segments", body="SELECT * FROM segments"))
def _join_station_coords(spark, sf):
    """The whole segment table, coordinates of both ends included."""
    return segments(spark, sf)


@query("join_ordered_pairs", using("journeys", body="""
SELECT trip_id, from_index, to_index, from_station, to_station, train_category, train_number,
  service_date, departure_delay_at_from, arrival_delay_at_to, delay_gained,
  cast(planned_journey_minutes AS double) AS planned_journey_minutes, stops_between,
  either_cancelled
FROM journeys
"""))
def _join_ordered_pairs(spark, sf):
    return gold.journeys(stops(spark, sf))


@query("join_station_dim", """
SELECT 8000000 + s_suppkey AS station_eva, concat('S', s_suppkey) AS station_name,
  s_name AS stada_name,
  CASE WHEN s_suppkey % 13 <> 0 THEN 47.0::double + s_suppkey % 8
    WHEN s_suppkey = 26 THEN 47.5672::double END AS latitude,
  CASE WHEN s_suppkey % 13 <> 0 THEN 6.0::double + s_suppkey % 9
    WHEN s_suppkey = 26 THEN 7.6077::double END AS longitude,
  CASE WHEN s_suppkey % 13 <> 0 THEN 'stada' WHEN s_suppkey = 26 THEN 'manual' ELSE 'missing' END
    AS coordinate_source,
  cast(s_suppkey % 7 AS bigint) AS category, concat('L', s_nationkey) AS federal_state,
  s_suppkey * 3 AS route_calls
FROM supplier
""")
def _join_station_dim(spark, sf):
    """Targets with master coordinates, one by hand, the rest without."""
    supplier = frames.table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    targets = supplier.select(
        (key + 8_000_000).alias("eva"), F.concat(F.lit("S"), key).alias("name"),
        F.col("s_name").alias("stada_name"), (key % 7).cast("int").alias("category"),
        F.concat(F.lit("L"), F.col("s_nationkey")).alias("federal_state"),
        (key * 3).alias("route_calls"))
    return station_plans.station_dimension(
        targets, files.explode_eva_numbers(master_entries(supplier)),
        station_plans.manual_coordinates(spark))


def master_entries(supplier):
    """One station per supplier with two numbers, the second without coordinates."""
    key = F.col("s_suppkey")

    def position(*values):
        return F.struct(F.array(*values).alias("coordinates"))

    here = position((F.lit(6.0) + key % 9), (F.lit(47.0) + key % 8))
    none = F.lit(None).cast("struct<coordinates: array<double>>")

    def entry(number, is_main, where):
        return F.struct(number.alias("number"), is_main.alias("isMain"),
                        where.alias("geographicCoordinates"))

    return supplier.select(
        key.alias("number"), F.col("s_name").alias("name"),
        (key % 7).cast("int").alias("category"),
        F.concat(F.lit("L"), F.col("s_nationkey")).alias("federalState"),
        F.array(
            entry(key + 8_000_000, F.lit(True), F.when(key % 13 != 0, here).otherwise(none)),
            entry(key + 9_000_000, F.lit(False), none)).alias("evaNumbers"))


def timetable_tables(spark, sf):
    """Orders as trips, customers as routes, nations as agencies (every sixth missing)."""
    trips = frames.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.col("o_custkey").cast("string").alias("route_id"),
        F.concat(F.lit("V"), F.col("o_orderkey") % 200).alias("service_id"))
    routes = frames.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("route_id"),
        F.col("c_nationkey").cast("string").alias("agency_id"),
        F.col("c_mktsegment").alias("route_short_name"))
    agency = frames.table(spark, sf, "nation").filter("n_nationkey % 6 <> 0").select(
        F.col("n_nationkey").cast("string").alias("agency_id"),
        F.col("n_name").alias("agency_name"))
    return trips, routes, agency


@query("join_trip_route_agency", """
SELECT cast(c_nationkey AS varchar) AS agency_id, coalesce(n_name, '?') AS agency_name,
  c_mktsegment AS route_short_name, cast(c_custkey AS varchar) AS route_id, count(*) AS trips
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 6 <> 0) ON n_nationkey = c_nationkey
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
GROUP BY ALL
""")
def _join_trip_route_agency(spark, sf):
    trips, routes, agency = timetable_tables(spark, sf)
    in_feed = frames.table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").cast("string").alias("trip_id"))
    return timetable.matched_breakdown(trips, routes, agency, in_feed)


def _tracks(spark, sf):
    return geometry(spark, sf).withColumn("track_km", F.round(F.col("metres") / 1000, 1))


@query("join_segment_geometry", using("geometry", "segments", body="""
SELECT g.from_station, g.to_station, track_km, cast(len(coordinates) AS bigint) AS geometry_points,
  hops, trips, avg_delay_gained_minutes, median_delay_gained_minutes, trips_losing_time,
  trips_recovering_time
FROM geometry g JOIN segments s ON s.from_station = g.from_station
  AND s.to_station = g.to_station AND s.hops = 1
"""))
def _join_segment_geometry(spark, sf):
    return geo.segment_geometry_table(_tracks(spark, sf), segments(spark, sf)) \
        .drop("coordinates")


@query("explode_points", using("geometry", "segments", body="""
WITH sg AS (SELECT g.*, s.trips, s.avg_delay_gained_minutes, s.trips_losing_time,
    s.trips_recovering_time,
    list_filter(coordinates, lambda p, i: (i - 1) % greatest(1,
      cast(floor(len(coordinates) / 60) AS bigint)) = 0) AS sampled
  FROM geometry g JOIN segments s ON s.from_station = g.from_station
    AND s.to_station = g.to_station AND s.hops = 1)
SELECT from_station, to_station, track_km, trips, avg_delay_gained_minutes, trips_losing_time,
  trips_recovering_time, from_station || ' -> ' || to_station AS segment,
  sampled[i][2] AS latitude, sampled[i][1] AS longitude, cast(i - 1 AS bigint) AS point_index
FROM (SELECT *, unnest(range(1, len(sampled) + 1)) AS i FROM sg)
"""))
def _explode_points(spark, sf):
    return geo.geometry_points_table(
        geo.segment_geometry_table(_tracks(spark, sf), segments(spark, sf)))


@query("anti_join_incremental", using("geometry", "segments", body="""
SELECT DISTINCT from_station, to_station, from_latitude, from_longitude, to_latitude, to_longitude
FROM segments s WHERE hops = 1 AND from_latitude IS NOT NULL AND to_latitude IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM geometry g WHERE g.from_station = s.from_station
    AND g.to_station = s.to_station)
"""))
def _anti_join_incremental(spark, sf):
    """Adjacent pairs whose track is still to be resolved."""
    return geo.unresolved_pairs(segments(spark, sf), geometry(spark, sf))


@query("semi_anti_reconcile", f"""
WITH l AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F'),
r AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 5 <> 0 UNION
  SELECT o_custkey + 1000000000 FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 9 = 0),
c AS (SELECT (SELECT count(*) FROM l WHERE id IN (SELECT id FROM r)) AS matched,
  (SELECT count(*) FROM l WHERE id NOT IN (SELECT id FROM r)) AS only_left,
  (SELECT count(*) FROM r WHERE id NOT IN (SELECT id FROM l)) AS only_right)
SELECT *, {pct("matched", "(matched + only_left)")} AS pct_of_left,
  {pct("matched", "(matched + only_right)")} AS pct_of_right FROM c
""")
def _semi_anti_reconcile(spark, sf):
    orders = frames.table(spark, sf, "orders")
    left = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    right = frames.table(spark, sf, "customer").filter("c_custkey % 5 <> 0").select(
        F.col("c_custkey").alias("id")
    ).unionByName(orders.filter("o_orderstatus = 'O' AND o_orderkey % 9 = 0").select(
        (F.col("o_custkey") + 1_000_000_000).alias("id")))
    return reconcile_ids(left, right, "id")


def sequences(spark, sf):
    return stop_sequences(
        last(spark, sf).select("trip_id", F.col("stop_index").alias("stop_sequence"),
                               F.col("station_name").alias("stop_id")))


@query("join_sequence_fingerprint", using("last_obs", body="""
WITH seq AS (SELECT l_orderkey, trip_id, list(station_name ORDER BY stop_index) AS stops
  FROM last_obs GROUP BY 1, 2)
SELECT trip_id, cast(len(stops) AS bigint) AS length FROM seq
WHERE l_orderkey % 3 <> 0 AND stops IN (SELECT stops FROM seq WHERE l_orderkey % 3 = 0)
"""))
def _join_sequence_fingerprint(spark, sf):
    """A third of the trips is the known side; all others whose whole stop sequence it has."""
    seq = sequences(spark, sf)
    third = F.col("trip_id").cast("long") % 3
    hits = fingerprint_matches(seq.filter(third != 0), seq.filter(third == 0))
    return hits.select("trip_id", F.size("stops").alias("length"))


@query("seq_match_class", using("last_obs", body="""
WITH seq AS (SELECT l_orderkey, list(station_name ORDER BY stop_index) AS b,
    list(CASE WHEN l_orderkey % 4 = 2 OR (l_orderkey % 4 = 3 AND stop_index % 2 = 0)
      THEN 'X' || station_name ELSE station_name END ORDER BY stop_index)
      FILTER (WHERE NOT (l_orderkey % 4 = 1 AND stop_index = 1)) AS a
  FROM last_obs GROUP BY 1)
SELECT CASE WHEN a = b THEN 'exact'
    WHEN list_has_all(a, b) OR list_has_all(b, a) THEN 'subset'
    WHEN NOT list_has_any(a, b) THEN 'disjoint' ELSE 'other' END AS match_class,
  count(*) AS trips
FROM seq WHERE a IS NOT NULL GROUP BY 1
"""))
def _seq_match_class(spark, sf):
    """A feed that repeats, shortens, replaces or mixes up the planned stops."""
    rows = last(spark, sf).select(
        "trip_id", F.col("stop_index").alias("stop_sequence"),
        F.col("station_name").alias("stop_id"))
    kind = F.col("trip_id").cast("long") % 4
    position = F.col("stop_sequence")
    fed = rows.filter(~((kind == 1) & (position == 1))).withColumn(
        "stop_id", F.when((kind == 2) | ((kind == 3) & (position % 2 == 0)),
                          F.concat(F.lit("X"), "stop_id")).otherwise(F.col("stop_id")))
    classes = timetable.match_classes(stop_sequences(fed), stop_sequences(rows))
    return classes.groupBy("match_class").agg(F.count(F.lit(1)).alias("trips"))


CHANGE_SQL = """
WITH state AS (SELECT key, cycle, arg_max(content, position) AS content FROM polls GROUP BY 1, 2),
changed AS (SELECT s.key, s.cycle FROM state s LEFT JOIN state p
  ON p.key = s.key AND p.cycle = s.cycle - 1 AND p.content = s.content WHERE p.key IS NULL)
SELECT key, cycle, position, content FROM polls JOIN changed USING (key, cycle)
"""


@query("change_filter_batch", using("polls", body=CHANGE_SQL))
def _change_filter_batch(spark, sf):
    return changed_since_previous(polls(spark, sf)).select(
        "key", "cycle", "position", "content")


@query("plan_slot_worklist", """
WITH now AS (SELECT timezone('Europe/Berlin', TIMESTAMPTZ '2026-05-10 12:00:00+00') AS t),
w AS (SELECT s_suppkey AS eva, cast(unnest(range(-9, 9)) AS bigint) AS "offset" FROM supplier),
slots AS (SELECT w.*, strftime(t + to_hours("offset"), '%y%m%d%H') AS slot FROM w, now),
fetched AS (SELECT DISTINCT l_suppkey AS eva,
  strftime(t + to_hours(l_partkey % 997 - 498), '%y%m%d%H') AS slot FROM lineitem, now),
kept AS (SELECT f.* FROM fetched f, now
  WHERE slot[1:6] >= strftime(t - INTERVAL 2 DAY, '%y%m%d'))
SELECT eva, "offset", slot FROM slots s
WHERE "offset" IN (0, 1) OR NOT EXISTS (
  SELECT 1 FROM kept f WHERE f.eva = s.eva AND f.slot = s.slot)
""")
def _plan_slot_worklist(spark, sf):
    """Hours still to read; hours that the order lines stand for were read before."""
    now = F.lit("2026-05-10T12:00:00Z").cast("timestamp")
    targets = frames.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("eva"))
    local = F.unix_timestamp(F.from_utc_timestamp(now, "Europe/Berlin"))
    hour = F.timestamp_seconds(local + (F.col("l_partkey") % 997 - 498) * 3600)
    fetched = frames.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("eva"), F.date_format(hour, "yyMMddHH").alias("slot"))
    return ingest.plan_worklist(targets, now, ingest.recent_slots(fetched, now))


@query("poll_targets", """
WITH calls AS (SELECT concat('S', l_suppkey) AS name, l_suppkey AS k, count(*) AS route_calls
  FROM lineitem GROUP BY 1, 2),
probe AS (SELECT l_suppkey + 8000000 AS eva, count(*) AS calls FROM lineitem
  WHERE l_suppkey % 4 <> 0 GROUP BY 1),
named AS (SELECT c.name, c.route_calls,
    CASE WHEN p1.eva IS NOT NULL THEN c.k + 8000000 WHEN p2.eva IS NOT NULL THEN c.k + 8000001
      END AS eva
  FROM calls c LEFT JOIN probe p1 ON p1.eva = c.k + 8000000
    LEFT JOIN probe p2 ON p2.eva = c.k + 8000001),
top AS (SELECT * FROM named WHERE eva IS NOT NULL ORDER BY route_calls DESC, name LIMIT 60)
SELECT eva, name, route_calls, s_name AS stada_name, s_suppkey AS station_number,
  cast(s_suppkey % 7 AS bigint) AS category, concat('L', s_nationkey) AS federal_state,
  CASE WHEN s_suppkey % 13 <> 0 THEN 6.0::double + s_suppkey % 9 END AS longitude,
  CASE WHEN s_suppkey % 13 <> 0 THEN 47.0::double + s_suppkey % 8 END AS latitude
FROM top LEFT JOIN supplier ON s_suppkey = eva - 8000000
""")
def _poll_targets(spark, sf):
    """The 60 most called stations, with the first number that answers."""
    lines = frames.table(spark, sf, "lineitem")
    supplier = frames.table(spark, sf, "supplier")
    key = F.col("l_suppkey")
    calls = lines.groupBy(F.concat(F.lit("S"), key).alias("name")).agg(
        F.count(F.lit(1)).alias("route_calls"))
    number = F.col("s_suppkey") + 8_000_000
    candidates = supplier.select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("name"),
        F.array(number, number + 1).alias("candidates"))
    probe = lines.filter(key % 4 != 0).groupBy((key + 8_000_000).alias("eva")).agg(
        F.count(F.lit(1)).alias("calls"))
    return station_plans.poll_targets(
        calls, candidates, probe, files.explode_eva_numbers(master_entries(supplier)), 60)
