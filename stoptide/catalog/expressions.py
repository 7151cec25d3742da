"""Scalar expressions on the observation frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    brand_fallback,
    cancel_flag,
    content_digest,
    db_timestamp,
    delay_minutes,
    downsample,
    in_scope,
    is_long_distance,
    iso_timestamp,
    path_array,
    percent,
    planned_minutes,
    platform_change,
    point_at,
    route_build,
    route_destination,
    route_origin,
    segment_label,
    service_date,
    split_stop_id,
    track_km,
)
from ..plans.gold import consecutive_stops
from ..plans.ingest import strict_long_distance
from ..plans.silver import flatten, silver
from ..sources import frames
from .derived import geometry, last, stops
from .oracle import LONG, count_if, joined, rounded, route, text, using
from .registry import query

KEY = ["stop_id", "observed_at"]
KEY_SQL = f"stop_id, {text('observed_at')} AS observed_at"


def berlin_to_utc(local: str) -> str:
    """Of the two readings in the autumn overlap the first, as Spark takes it."""
    utc = f"timezone('UTC', timezone('Europe/Berlin', {local}))"
    hour_before = f"({utc} - INTERVAL 1 HOUR)"
    same = f"timezone('Europe/Berlin', timezone('UTC', {hour_before})) = {local}"
    return f"CASE WHEN {same} THEN {hour_before} ELSE {utc} END"


@query("db_timestamp", using("f", body=f"""
SELECT {KEY_SQL}, db_text,
  {text(berlin_to_utc("try_strptime('20' || db_text, '%Y%m%d%H%M')"))} AS instant
FROM (SELECT *, CASE WHEN station_eva % 23 = 0 THEN '' WHEN station_eva % 29 = 0 THEN 'soon'
    WHEN station_eva % 31 = 0 THEN NULL ELSE strftime(planned_arrival_at, '%y%m%d%H%M') END
  AS db_text FROM f)
"""))
def _db_timestamp(spark, sf):
    """Berlin local texts to instants; malformed ones become NULL."""
    eva = F.col("station_eva")
    value = (F.when(eva % 23 == 0, F.lit("")).when(eva % 29 == 0, F.lit("soon"))
             .when(eva % 31 == 0, F.lit(None).cast("string"))
             .otherwise(F.date_format("planned_arrival_at", "yyMMddHHmm")))
    return frames.observations(spark, sf).select(*KEY, value.alias("db_text")) \
        .withColumn("instant", db_timestamp(F.col("db_text")))


@query("iso_timestamp", using("f", body=f"""
SELECT {KEY_SQL}, CASE WHEN station_eva % 23 <> 0 THEN {text("observed_at - INTERVAL 2 HOUR")} END
  AS instant FROM f
"""))
def _iso_timestamp(spark, sf):
    iso = F.when(F.col("station_eva") % 23 == 0, F.lit("no time")).otherwise(
        F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    return frames.observations(spark, sf).select(*KEY, iso_timestamp(iso).alias("instant"))


@query("delay_minutes", using("f", body=f"""
SELECT {KEY_SQL},
  cast(trunc((epoch(changed_arrival_at) - epoch(planned_arrival_at) + station_eva % 120 - 60) / 60)
    AS bigint) AS delay
FROM f
"""))
def _delay_minutes(spark, sf):
    """Differences with odd seconds, cut towards zero on both sides of it."""
    shifted = F.timestamp_seconds(
        F.unix_timestamp("changed_arrival_at") + F.col("station_eva") % 120 - 60)
    return frames.observations(spark, sf).select(
        *KEY, delay_minutes(F.col("planned_arrival_at"), shifted).alias("delay"))


@query("cancel_flag", using("f", body=f"""
SELECT {KEY_SQL}, coalesce(arrival_status = 'c', false) OR coalesce(departure_status = 'c', false)
  AS is_cancelled FROM f
"""))
def _cancel_flag(spark, sf):
    return frames.observations(spark, sf).select(
        *KEY, cancel_flag(F.col("arrival_status"), F.col("departure_status"))
        .alias("is_cancelled"))


@query("change_predicates", using("consecutive", body=f"""
SELECT to_station, {count_if("delay_gained > 0")} AS losing,
  {count_if("delay_gained < 0")} AS recovering,
  {count_if("delay_gained IS NOT NULL")} AS known,
  {count_if("NOT either_cancelled")} AS running
FROM consecutive GROUP BY to_station
"""))
def _change_predicates(spark, sf):
    gained = F.col("delay_gained")
    return consecutive_stops(stops(spark, sf)).groupBy("to_station").agg(
        F.count_if(gained > 0).alias("losing"), F.count_if(gained < 0).alias("recovering"),
        F.count_if(gained.isNotNull()).alias("known"),
        F.count_if(~F.col("either_cancelled")).alias("running"))


@query("content_digest", using("f", body="""
SELECT trip_id, stop_id, count(*) AS observations, count(DISTINCT {
  'a': changed_arrival_at, 'b': changed_departure_at, 'c': changed_arrival_platform,
  'd': changed_path_from, 'e': changed_path_to, 'f': arrival_status, 'g': departure_status,
  'h': CASE WHEN l_partkey % 2 = 0 THEN concat(l_returnflag, l_linestatus) END}) AS contents
FROM f GROUP BY trip_id, stop_id
"""))
def _content_digest(spark, sf):
    """Equal digests mean equal content: contents per stop, counted by digest."""
    digest = content_digest(
        "changed_arrival_at", "changed_departure_at", "changed_arrival_platform",
        "changed_path_from", "changed_path_to", "arrival_status", "departure_status",
        "messages")
    return frames.observations(spark, sf).select("trip_id", "stop_id", digest.alias("d")) \
        .groupBy("trip_id", "stop_id") \
        .agg(F.count(F.lit(1)).alias("observations"), F.count_distinct("d").alias("contents"))


@query("label_concat", using("consecutive", body="""
SELECT from_station || ' -> ' || to_station AS segment, count(*) AS trips
FROM consecutive GROUP BY 1
"""))
def _label_concat(spark, sf):
    label = segment_label(F.col("from_station"), F.col("to_station"))
    return consecutive_stops(stops(spark, sf)).groupBy(label.alias("segment")).agg(
        F.count(F.lit(1)).alias("trips"))


@query("nested_index", using("geometry", body="""
SELECT vec_id, coordinates[6][2] AS latitude, coordinates[6][1] AS longitude FROM geometry
"""))
def _nested_index(spark, sf):
    """The sixth point of every track."""
    point = F.get("coordinates", F.lit(5))
    return geometry(spark, sf).select(
        "vec_id", point_at(point, 1).alias("latitude"), point_at(point, 0).alias("longitude"))


@query("geometry_stats", using("geometry", body=f"""
SELECT vec_id, cast(len(coordinates) AS bigint) AS geometry_points,
  {rounded("(vec_id * 137 % 90000) / 1000", 1)} AS track_km,
  coordinates[1][1] AS first_longitude FROM geometry
"""))
def _geometry_stats(spark, sf):
    return geometry(spark, sf).select(
        "vec_id", F.size("coordinates").alias("geometry_points"),
        track_km(F.col("metres")).alias("track_km"),
        F.get(F.get("coordinates", F.lit(0)), F.lit(0)).alias("first_longitude"))


@query("geometry_downsample", using("geometry", body="""
SELECT vec_id, len(sampled) AS points, sampled[len(sampled)][1] AS last_index
FROM (SELECT vec_id, list_filter(coordinates, lambda p, i:
    (i - 1) % greatest(1, cast(floor(len(coordinates) / 60) AS bigint)) = 0) AS sampled
  FROM geometry)
"""))
def _geometry_downsample(spark, sf):
    sampled = downsample(F.col("coordinates"))
    return geometry(spark, sf).select("vec_id", sampled.alias("sampled")).select(
        "vec_id", F.size("sampled").alias("points"),
        F.get(F.try_element_at("sampled", F.lit(-1)), F.lit(0)).alias("last_index"))


@query("format_percent", using("f", body="""
SELECT train_category, stop_index,
  CASE WHEN count(arrival_delay_minutes) FILTER (WHERE stop_index > 3) = 0 THEN 'n/a' ELSE
    printf('%.2f%%', 100.0::double * count(*) FILTER (WHERE arrival_delay_minutes > 5 AND stop_index > 3)
      / count(arrival_delay_minutes) FILTER (WHERE stop_index > 3)) END AS late
FROM f GROUP BY train_category, stop_index
"""))
def _format_percent(spark, sf):
    """Share of late stops beyond the third as text; the first three have none."""
    far = F.col("stop_index") > 3
    late = F.count_if(far & (F.col("arrival_delay_minutes") > 5))
    known = F.count_if(far & F.col("arrival_delay_minutes").isNotNull())
    return frames.observations(spark, sf).groupBy("train_category", "stop_index").agg(
        percent(late, known).alias("late"))


@query("path_array", using("f", body=f"""
SELECT {KEY_SQL}, {joined("path_from")} AS path_from, {joined("path_to")} AS path_to FROM f
"""))
def _path_array(spark, sf):
    return frames.observations(spark, sf).select(
        *KEY, path_array(F.col("changed_path_from"), F.col("planned_path_from"))
        .alias("path_from"),
        path_array(F.col("changed_path_to"), F.col("planned_path_to")).alias("path_to"))


@query("split_stop_id", using("f", body=f"""
SELECT {KEY_SQL}, CASE WHEN station_eva % 5 = 0 THEN '-' || trip_id ELSE trip_id END AS trip,
  strftime(start_at, '%y%m%d%H%M') AS start, stop_index AS position
FROM f WHERE station_eva % 13 <> 0
"""))
def _split_stop_id(spark, sf):
    """Some trip ids negative; ids with a bad index are skipped."""
    eva = F.col("station_eva")
    raw = F.when(eva % 13 == 0, F.concat("stop_id", F.lit("x"))) \
        .when(eva % 5 == 0, F.concat(F.lit("-"), "stop_id")).otherwise(F.col("stop_id"))
    trip, start, index = split_stop_id(F.col("raw"))
    return frames.observations(spark, sf).select(*KEY, raw.alias("raw")).select(
        *KEY, trip.alias("trip"), start.alias("start"), index.alias("position")
    ).filter("position IS NOT NULL")


@query("brand_fallback", using("f", body="""
SELECT coalesce(brand, train_operator) AS train_brand, count(*) AS n FROM f GROUP BY 1
"""))
def _brand_fallback(spark, sf):
    brand = brand_fallback(F.col("brand"), F.col("train_operator"))
    return frames.observations(spark, sf).groupBy(brand.alias("train_brand")).agg(
        F.count(F.lit(1)).alias("n"))


@query("route_build", using("base", body=f"""
SELECT stop_id, {joined("route")} AS route, cast(len(route) AS bigint) AS names FROM base
"""))
def _route_build(spark, sf):
    built = route_build(F.col("path_from"), F.col("station_name"), F.col("path_to"))
    return last(spark, sf).select("stop_id", built.alias("route")) \
        .withColumn("names", F.size("route"))


@query("route_endpoints", using("base", body="""
SELECT stop_id, CASE WHEN len(route) >= 2 THEN route[1] END AS origin,
  CASE WHEN len(route) >= 2 THEN route[-1] END AS destination FROM base
"""))
def _route_endpoints(spark, sf):
    built = route_build(F.col("path_from"), F.col("station_name"), F.col("path_to"))
    return last(spark, sf).select("stop_id", built.alias("route")).select(
        "stop_id", route_origin(F.col("route")).alias("origin"),
        route_destination(F.col("route")).alias("destination"))


@query("service_date", using("f", body=f"""
SELECT {KEY_SQL}, strftime(planned_departure_at, '%Y-%m-%d') AS utc_date,
  strftime(timezone('Europe/Berlin', timezone('UTC', planned_departure_at + INTERVAL 18 HOUR)),
    '%Y-%m-%d') AS local_date
FROM f
"""))
def _service_date(spark, sf):
    late = F.timestamp_seconds(F.unix_timestamp("planned_departure_at") + 18 * 3600)
    none = F.lit(None).cast("timestamp")
    return frames.observations(spark, sf).select(
        *KEY, service_date(none, F.col("planned_departure_at")).alias("utc_date"),
        service_date(late, none, local_date=True).alias("local_date"))


@query("long_distance_flag", using("f", body=f"""
SELECT train_category, train_category IN {LONG} AS is_long_distance, count(*) AS n
FROM f GROUP BY 1, 2
"""))
def _long_distance_flag(spark, sf):
    return frames.observations(spark, sf).groupBy(
        "train_category", is_long_distance(F.col("train_category")).alias("is_long_distance")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("scope_filter", using("f", body=f"""
SELECT {KEY_SQL}, train_filter FROM f WHERE train_filter IS NULL OR train_filter = 'F'
"""))
def _scope_filter(spark, sf):
    return frames.observations(spark, sf).filter(in_scope(F.col("train_filter"))) \
        .select(*KEY, "train_filter")


@query("strict_long_distance", using("f", body=f"""
SELECT {KEY_SQL}, train_filter FROM f WHERE train_filter = 'F'
"""))
def _strict_long_distance(spark, sf):
    return strict_long_distance(frames.observations(spark, sf)).select(*KEY, "train_filter")


@query("platform_change", using("f", body=f"""
SELECT {KEY_SQL}, CASE WHEN coalesce(changed_arrival_platform, '') <> ''
    AND changed_arrival_platform IS DISTINCT FROM planned
  THEN coalesce(planned, '') || '->' || changed_arrival_platform
  ELSE coalesce(planned, '') END AS platform
FROM (SELECT *, CASE WHEN station_eva % 9 <> 0 THEN planned_arrival_platform END AS planned FROM f)
"""))
def _platform_change(spark, sf):
    planned = F.when(F.col("station_eva") % 9 != 0, F.col("planned_arrival_platform"))
    return frames.observations(spark, sf).select(
        *KEY, platform_change(planned, F.col("changed_arrival_platform")).alias("platform"))


@query("planned_minutes", using("f", body=f"""
SELECT {KEY_SQL}, (epoch(planned_departure_at) - epoch(start_at)) / 60 AS minutes FROM f
"""))
def _planned_minutes(spark, sf):
    return frames.observations(spark, sf).select(
        *KEY, planned_minutes(F.col("planned_departure_at"), F.col("start_at"))
        .alias("minutes"))


@query("json_flatten", using("f", body="""
SELECT kafka_partition, kafka_offset, stop_id, station_eva, stop_index, brand,
  planned_path_from, changed_path_to, arrival_status FROM f
"""))
def _json_flatten(spark, sf):
    """Fields of the JSON payload next to the place of its record."""
    return flatten(frames.records(frames.payloads(spark, sf))).select(
        "kafka_partition", "kafka_offset", "stop_id", "station_eva", "stop_index", "brand",
        "planned_path_from", "changed_path_to", "arrival_status")


def _silver_sql() -> str:
    def instant(column: str) -> str:
        # The payload has two-digit years: 1998 is read as 2098.
        shifted = f"strptime('20' || strftime({column}, '%y%m%d%H%M'), '%Y%m%d%H%M')"
        return berlin_to_utc(shifted)

    def delay(changed: str, planned: str) -> str:
        return (f"cast(trunc((epoch({instant(changed)}) - epoch({instant(planned)})) / 60) "
                f"AS bigint)")

    return using("f", body=f"""
SELECT stop_id, {text("observed_at - INTERVAL 2 HOUR")} AS observed_at,
  kafka_partition, kafka_offset, station_eva, trip_id, stop_index,
  {text(instant("start_at"))} AS start_at,
  {text(instant("planned_arrival_at"))} AS planned_arrival_at,
  {text(instant("changed_departure_at"))} AS changed_departure_at,
  {text(f"CASE WHEN is_cancelled THEN {instant('planned_arrival_at')} END")} AS cancelled_at,
  {delay("changed_arrival_at", "planned_arrival_at")} AS arrival_delay_minutes,
  {delay("changed_departure_at", "planned_departure_at")} AS departure_delay_minutes,
  coalesce(arrival_status = 'c', false) OR coalesce(departure_status = 'c', false)
    AS is_cancelled,
  {joined(route("changed_path_from", "planned_path_from"))} AS path_from,
  {joined(route("changed_path_to", "planned_path_to"))} AS path_to
FROM f
""")


SILVER_COLUMNS = [
    "stop_id", "observed_at", "kafka_partition", "kafka_offset", "station_eva", "trip_id",
    "stop_index", "start_at", "planned_arrival_at", "changed_departure_at", "cancelled_at",
    "arrival_delay_minutes", "departure_delay_minutes", "is_cancelled", "path_from", "path_to",
]


@query("silver_parse", _silver_sql())
def _silver_parse(spark, sf):
    """Records with JSON payloads to typed Silver observations."""
    return silver(frames.records(frames.payloads(spark, sf))).select(*SILVER_COLUMNS)
