"""Files and documents: XML, timetable CSV, station master, reference JSON, saved tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.stacking import stack
from ..plans import gold, ingest, poll, timetable
from ..session import scratch_dir, shuffle_width
from ..sources import documents, files, frames, kafka, sinks
from .derived import geometry, last, stops
from .joins import master_entries, timetable_tables
from .oracle import joined, text, using
from .registry import query


def _attribute(name: str, value) -> Column:
    """` name="value"`, nothing for NULL."""
    return F.when(value.isNull(), F.lit("")).otherwise(
        F.concat(F.lit(f' {name}="'), value, F.lit('"')))


def plan_documents(spark, sf):
    """One plan document per stop: the stop itself, and one without an arrival."""
    rows = last(spark, sf)
    c = F.col
    stop = F.concat(
        F.lit("<s"), _attribute("id", c("stop_id")), F.lit("><tl t=\"p\""),
        _attribute("f", c("train_filter")), _attribute("o", c("train_operator")),
        _attribute("c", c("train_category")), _attribute("n", c("train_number")),
        F.lit("/><ar"), _attribute("pt", F.date_format("planned_arrival_at", "yyMMddHHmm")),
        _attribute("pp", c("planned_arrival_platform")),
        _attribute("ppth", c("planned_path_from")),
        F.lit("/><dp"), _attribute("pt", F.date_format("planned_departure_at", "yyMMddHHmm")),
        _attribute("ppth", c("planned_path_to")), F.lit("/></s>"))
    extra = F.concat(
        F.lit("<s"), _attribute("id", F.concat("stop_id", F.lit("0"))), F.lit("><dp"),
        _attribute("pt", F.date_format("planned_departure_at", "yyMMddHHmm")), F.lit("/></s>"))
    return rows.select(F.concat(
        F.lit("<timetable"), _attribute("station", c("station_name")), F.lit(">\n "),
        stop, F.lit("\n "), extra, F.lit("</timetable>")).alias("document"))


PLAN_SQL = """
SELECT stop_id, train_category, train_number, train_operator, train_filter,
  strftime(planned_arrival_at, '%y%m%d%H%M') AS planned_arrival,
  strftime(planned_departure_at, '%y%m%d%H%M') AS planned_departure,
  planned_arrival_platform, planned_path_from, planned_path_to FROM last_obs
UNION ALL
SELECT stop_id || '0', NULL, NULL, NULL, NULL, NULL,
  strftime(planned_departure_at, '%y%m%d%H%M'), NULL, NULL, NULL FROM last_obs
"""


@query("src_xml_plan", using("last_obs", body=PLAN_SQL))
def _src_xml_plan(spark, sf):
    return documents.plan_stops(plan_documents(spark, sf)) \
        .drop("planned_departure_platform")


def change_documents(spark, sf):
    """One change document per observation, with messages at three levels."""
    rows = frames.observations(spark, sf)
    c = F.col
    number = c("station_eva")
    deep = F.when(number % 3 == 0, F.lit('<m id="z" t="r" c="7"/>')).otherwise(F.lit(""))
    clock = F.date_format("planned_arrival_at", "yyMMddHHmm")
    stop = F.concat(
        F.lit("<s"), _attribute("id", c("stop_id")), F.lit(">"),
        F.lit("<ar"), _attribute("ct", F.date_format("changed_arrival_at", "yyMMddHHmm")),
        _attribute("cp", c("changed_arrival_platform")),
        _attribute("cpth", c("changed_path_from")), _attribute("cs", c("arrival_status")),
        _attribute("clt", F.when(number % 2 == 0, clock).when(number % 5 == 0, F.lit(""))),
        F.lit(">"), deep, F.lit("</ar>"),
        F.lit("<dp"), _attribute("ct", F.date_format("changed_departure_at", "yyMMddHHmm")),
        _attribute("cs", c("departure_status")),
        _attribute("clt", F.when(number % 7 == 0, F.lit("2601010000"))),
        _attribute("fb", c("brand")), F.lit("/>"),
        F.lit('<m id="x" t="f" c="80"/><m id="y" t="q" cat="Bauarbeiten"/></s>'))
    return rows.select("observed_at", F.concat(
        F.lit("<?xml version='1.0'?>\n<timetable>"), stop, F.lit("</timetable>"))
        .alias("document"))


@query("src_xml_change", using("f", body=f"""
SELECT stop_id, {text("observed_at")} AS observed_at,
  strftime(changed_arrival_at, '%y%m%d%H%M') AS changed_arrival,
  strftime(changed_departure_at, '%y%m%d%H%M') AS changed_departure,
  changed_arrival_platform, changed_path_from, arrival_status, departure_status,
  CASE WHEN station_eva % 2 = 0 THEN strftime(planned_arrival_at, '%y%m%d%H%M')
    WHEN station_eva % 7 = 0 THEN '2601010000' END AS cancelled_at, brand,
  CASE WHEN station_eva % 3 = 0 THEN 'r/7/-;' ELSE '' END || 'f/80/-;q/-/Bauarbeiten' AS messages
FROM f
"""))
def _src_xml_change(spark, sf):
    """Messages keep the order arrival, departure, stop."""
    message = F.transform("messages", lambda m: F.array_join(m, "/", "-"))
    return documents.change_stops(change_documents(spark, sf)).select(
        "stop_id", "observed_at", "changed_arrival", "changed_departure",
        "changed_arrival_platform", "changed_path_from", "arrival_status", "departure_status",
        "cancelled_at", "brand", F.array_join(message, ";").alias("messages"))


def mixed_documents(spark, sf):
    """Web pages, empty timetables, junk, timetables with content, and cut off ones."""
    kind = F.col("page_id") % 5
    document = (
        F.when(kind == 0, F.col("html")).when(kind == 1, F.lit("<timetable/>"))
        .when(kind == 2, F.concat(F.lit("unavailable <timetable> "), "url"))
        .when(kind == 3, F.concat(
            F.lit("<?xml version='1.0'?>\n<!-- x --><timetable>\n <s"),
            _attribute("id", F.concat("page_id", F.lit("-2601010000-1"))),
            F.lit("/>\n</timetable>")))
        .otherwise(F.lit("<timetable><s id='1-2601010000-1'>")))
    name = F.element_at(
        F.array(*[F.lit(k) for k in ("page", "empty", "text", "timetable", "cut off")]),
        (kind + 1).cast("int"))
    return frames.table(spark, sf, "pages").select(
        "page_id", name.alias("kind"), document.alias("document"))


@query("src_xml_root_check", """
SELECT kind, failed, count(*) AS n FROM (
  SELECT CASE page_id % 5 WHEN 0 THEN 'page' WHEN 1 THEN 'empty' WHEN 2 THEN 'text'
    WHEN 3 THEN 'timetable' ELSE 'cut off' END AS kind, page_id % 5 NOT IN (1, 3) AS failed
  FROM pages)
GROUP BY 1, 2
""")
def _src_xml_root_check(spark, sf):
    return documents.parsed(mixed_documents(spark, sf), files.S.CHANGE_DOCUMENT) \
        .groupBy("kind", "failed").agg(F.count(F.lit(1)).alias("n"))


@query("poll_outcomes", """
SELECT page_id % 24 AS cycle,
  cast(count(*) FILTER (WHERE page_id % 5 IN (1, 3)) AS bigint) AS stations_polled,
  cast(count(*) FILTER (WHERE page_id % 5 NOT IN (1, 3)) AS bigint) AS stations_failed
FROM pages GROUP BY 1
""")
def _poll_outcomes(spark, sf):
    """Polled and failed stations per cycle."""
    return ingest.poll_outcomes(
        mixed_documents(spark, sf).withColumn("cycle", F.col("page_id") % 24), "cycle")


def poll_documents(spark, sf):
    """The events of a user and day as one document of its stop; every fourth cycle also has a
    document that is none."""
    events = frames.as_polls(frames.table(spark, sf, "events"))
    stop = F.concat(F.lit("<s"), _attribute("id", F.concat("key", F.lit("-2601010000-1"))),
                    F.lit("><ar"), _attribute("cp", F.col("content")), F.lit("/></s>"))
    stops = F.transform(F.array_sort(F.collect_list(F.struct("position", stop.alias("s")))),
                        lambda x: x["s"])
    sound = events.groupBy("key", "cycle").agg(F.concat(
        F.lit("<timetable>"), F.array_join(stops, ""), F.lit("</timetable>")).alias("document"))
    faulty = events.filter("cycle % 4 = 0").select("cycle").distinct().select(
        F.lit(0).cast("long").alias("key"), "cycle", F.lit("<html/>").alias("document"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("cycle"))
    return sound.unionByName(faulty).select(
        "document", "cycle", F.col("key").alias("station_eva"), F.lit("X").alias("station_name"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T12:00:00+00:00"))
        .alias("observed_at"))


@query("poll_job", using("polls", body="""
WITH seen AS (SELECT * FROM polls WHERE key % 3 <> 1),
state AS (SELECT key, cycle, arg_max(content, position) AS content FROM seen GROUP BY 1, 2),
changed AS (SELECT s.key, s.cycle FROM state s LEFT JOIN state p
  ON p.key = s.key AND p.cycle = s.cycle - 1 AND p.content = s.content WHERE p.key IS NULL),
written AS (SELECT cycle, count(*) AS n FROM seen JOIN changed USING (key, cycle) GROUP BY 1)
SELECT cycle, count(DISTINCT key) AS stations_polled,
  cast(CASE WHEN cycle % 4 = 0 THEN 1 ELSE 0 END AS bigint) AS stations_failed,
  count(*) AS changed_stops,
  cast(count(*) FILTER (WHERE key % 3 <> 2) AS bigint) AS identified,
  cast(count(*) FILTER (WHERE key % 3 = 2) AS bigint) AS unidentified,
  cast(count(*) FILTER (WHERE key % 3 <> 1) AS bigint) AS observations,
  cast(count(*) FILTER (WHERE key % 3 <> 1) AS bigint) AS seen,
  coalesce(any_value(w.n), 0) AS written,
  cast(count(*) FILTER (WHERE key % 3 <> 1) - coalesce(any_value(w.n), 0) AS bigint)
    AS suppressed, coalesce(any_value(w.n), 0) AS lines
FROM polls LEFT JOIN written w USING (cycle) GROUP BY cycle
"""))
def _poll_job(spark, sf):
    """All polls in two runs, the second from the state of the first; lines as written.

    The second run is made twice, as after a crash: its lines are there once. A third of the stops is planned, a third is planned but out of scope, a third unknown.
    """
    out, fetched, planned = (scratch_dir(spark, n) for n in ("emitted", "fetched", "planned"))
    poll_documents(spark, sf).write.parquet(fetched)
    docs = spark.read.parquet(fetched)
    key = F.col("station_eva")
    wanted = docs.filter((key % 3 != 2) & F.col("document").startswith("<timetable")).select(
        F.concat(key, F.lit("-2601010000-1")).alias("stop_id"),
        F.when(key % 3 == 0, "F").otherwise("N").alias("train_filter")).distinct()
    plan = wanted.select("stop_id", *[
        F.col(c) if c == "train_filter" else F.lit("IC" if c == "train_category" else None)
        .cast("string").alias(c) for c in files.S.PLAN_FIELDS])
    plan.write.parquet(planned)
    plan = spark.read.parquet(planned)
    first, state = poll.run(docs.filter("cycle < 11"), plan, out)
    for _ in range(2):
        second, _ = poll.run(docs.filter("cycle >= 11"), plan, out, state)
    day = F.date_diff(F.col("dt").cast("date"), F.lit("2024-01-01").cast("date"))
    lines = spark.read.schema("stop_id STRING, dt STRING").json(out).groupBy(
        day.alias("cycle")).agg(F.count(F.lit(1)).alias("lines"))
    return first.unionByName(second).join(lines, "cycle", "left").fillna(0)


def _calendar(spark, sf):
    """Parts as weekly services, events as dated exceptions in event order."""
    part = frames.table(spark, sf, "part")
    key = F.col("p_partkey")
    calendar = part.select(
        F.concat(F.lit("V"), key).alias("service_id"),
        F.format_string("202401%02d", key % 15 + 1).alias("start_date"),
        F.format_string("202401%02d", key % 16 + 15).alias("end_date"),
        *[F.when((key + i) % 3 == 0, F.lit("1")).otherwise(F.lit("0")).alias(day)
          for i, day in enumerate(timetable.WEEKDAYS)])
    exceptions = frames.table(spark, sf, "events").select(
        F.concat(F.lit("V"), F.col("user_id")).alias("service_id"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("1")).otherwise(F.lit("2"))
        .alias("exception_type"), F.col("event_id").alias("line"))
    return calendar, exceptions


_ACTIVE = """
exceptions AS (SELECT concat('V', user_id) AS service_id, arg_max(event_type, event_id) AS e
  FROM events WHERE strftime(ts, '%Y%m%d') = '20240110' GROUP BY 1),
weekly AS (SELECT concat('V', p_partkey) AS service_id FROM part
  WHERE p_partkey % 15 + 1 <= 10 AND p_partkey % 16 + 15 >= 10 AND (p_partkey + 2) % 3 = 0),
active AS (
  SELECT service_id FROM weekly WHERE service_id NOT IN (SELECT service_id FROM exceptions)
  UNION SELECT service_id FROM exceptions WHERE e IN ('click', 'view'))
"""


@query("active_services", f"WITH {_ACTIVE} SELECT service_id FROM active")
def _active_services(spark, sf):
    """Services on Wednesday, 10 January 2024."""
    calendar, exceptions = _calendar(spark, sf)
    return timetable.active_services(calendar, exceptions, "20240110", order="line")


# Ninety days: two words of bits.
_FIRST, _LAST = "20231215", "20240313"


@query("active_services_range", f"""
WITH days AS (SELECT cast(d AS date) AS d FROM range(strptime('{_FIRST}', '%Y%m%d'),
  strptime('{_LAST}', '%Y%m%d') + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
exceptions AS (SELECT concat('V', user_id) AS service_id, cast(ts AS date) AS d,
  arg_max(event_type, event_id) AS e FROM events GROUP BY 1, 2),
weekly AS (SELECT concat('V', p_partkey) AS service_id, d FROM part, days
  WHERE strftime(d, '%Y%m%d') BETWEEN printf('202401%02d', p_partkey % 15 + 1)
    AND printf('202401%02d', p_partkey % 16 + 15) AND (p_partkey + isodow(d) - 1) % 3 = 0)
SELECT service_id, strftime(d, '%Y%m%d') AS date FROM (
  SELECT * FROM weekly ANTI JOIN exceptions USING (service_id, d)
  UNION ALL SELECT service_id, d FROM exceptions SEMI JOIN days USING (d)
  WHERE e IN ('click', 'view'))
""")
def _active_services_range(spark, sf):
    """Every day of a quarter at once, from bit sets per service."""
    calendar, exceptions = _calendar(spark, sf)
    return timetable.running_days(
        timetable.service_days(calendar, exceptions, _FIRST, _LAST, order="line"), _FIRST)


def _timetable(spark, sf):
    trips, routes, _ = timetable_tables(spark, sf)
    calendar, exceptions = _calendar(spark, sf)
    active = timetable.active_services(calendar, exceptions, "20240110", order="line")
    lines = frames.table(spark, sf, "lineitem")
    hour = F.col("l_linenumber") * 3 + F.col("l_orderkey") % 24
    moment = F.format_string("%02d:%02d:00", hour, F.col("l_partkey") % 60)
    spans = timetable.trip_time_spans(lines.select(
        F.col("l_orderkey").cast("string").alias("trip_id"), moment.alias("departure_time"),
        F.lit("").alias("arrival_time")))
    in_feed = lines.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").cast("string").alias("trip_id"))
    return trips, routes, spans, active, in_feed


def _coverage(spark, sf):
    return timetable.trip_coverage(*_timetable(spark, sf), F.lit("15:30:00"))


_COVERAGE = f"""
WITH {_ACTIVE},
spans AS (SELECT l_orderkey, min(t) AS lo, max(t) AS hi FROM (SELECT l_orderkey,
  printf('%02d:%02d:00', l_linenumber * 3 + l_orderkey % 24, l_partkey % 60) AS t FROM lineitem)
  GROUP BY 1),
coverage AS (
  SELECT cast(c_nationkey AS varchar) AS agency_id,
    CASE WHEN '15:30:00' BETWEEN coalesce(lo, '') AND coalesce(hi, '') THEN 'running'
      WHEN coalesce(lo, '') > '15:30:00' THEN 'not yet started' ELSE 'already finished' END AS state,
    o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS covered
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN spans ON l_orderkey = o_orderkey
  WHERE concat('V', o_orderkey % 200) IN (SELECT service_id FROM active))
"""


@query("coverage_by_state", _COVERAGE + """
SELECT state, cast(count(*) FILTER (WHERE covered) AS bigint) AS covered, count(*) AS total,
  cast(count(*) FILTER (WHERE covered AND agency_id = '9') AS bigint) AS agency_covered,
  cast(count(*) FILTER (WHERE agency_id = '9') AS bigint) AS agency_total,
  100 * cast(count(*) FILTER (WHERE covered) AS double) / count(*) AS pct,
  100 * cast(count(*) FILTER (WHERE covered AND agency_id = '9') AS double)
    / nullif(count(*) FILTER (WHERE agency_id = '9'), 0) AS agency_pct
FROM coverage GROUP BY state
""")
def _coverage_by_state(spark, sf):
    return timetable.coverage_by_state(_coverage(spark, sf), "9")


@query("coverage_by_agency", _COVERAGE + """
SELECT agency_id, coalesce(n_name, '?') AS agency_name,
  cast(count(*) FILTER (WHERE covered) AS bigint) AS covered, count(*) AS total,
  100 * cast(count(*) FILTER (WHERE covered) AS double) / count(*) AS pct
FROM coverage LEFT JOIN nation ON n_nationkey = agency_id AND n_nationkey % 6 <> 0
WHERE state = 'running' GROUP BY agency_id, n_name
""")
def _coverage_by_agency(spark, sf):
    _, _, agency = timetable_tables(spark, sf)
    return timetable.running_by_agency(_coverage(spark, sf), agency)


@query("coverage_by_minute", _COVERAGE.rpartition("coverage AS (")[0] + """
minutes AS (SELECT printf('%02d:%02d', m // 60, m % 60) AS minute FROM range(1440) t(m)),
known AS (SELECT coalesce(lo, '') AS lo, coalesce(hi, '') AS hi,
    o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS covered
  FROM orders LEFT JOIN spans ON l_orderkey = o_orderkey
  WHERE concat('V', o_orderkey % 200) IN (SELECT service_id FROM active)),
states AS (SELECT minute, covered, CASE WHEN minute || ':00' BETWEEN lo AND hi THEN 'running'
    WHEN lo > minute || ':00' THEN 'not yet started' ELSE 'already finished' END AS state
  FROM minutes, known),
grid AS (SELECT minute, unnest(['running', 'not yet started', 'already finished']) AS state
  FROM minutes)
SELECT g.minute, g.state, cast(count(*) FILTER (WHERE covered) AS bigint) AS covered,
  count(s.state) AS total
FROM grid g LEFT JOIN states s ON s.minute = g.minute AND s.state = g.state
GROUP BY g.minute, g.state
""")
def _coverage_by_minute(spark, sf):
    """Coverage by state at each of 1,440 minutes, from one pass over the trips."""
    return timetable.coverage_by_minute(timetable.active_trips(*_timetable(spark, sf)))


@query("src_gtfs_static", """
SELECT service_id, date, exception_type, count(*) AS n FROM (
  SELECT concat('V', user_id) AS service_id, strftime(ts, '%Y%m%d') AS date,
    CASE WHEN event_type IN ('click', 'view') THEN '1' ELSE '2' END AS exception_type FROM events)
GROUP BY 1, 2, 3
""")
def _src_gtfs_static(spark, sf):
    """A calendar_dates table written as CSV and read back as texts."""
    _, exceptions = _calendar(spark, sf)
    path = scratch_dir(spark, "gtfs")
    exceptions.select("service_id", "date", "exception_type") \
        .write.option("header", True).csv(path)
    return files.gtfs_table(spark, path, "calendar_dates") \
        .groupBy("service_id", "date", "exception_type").agg(F.count(F.lit(1)).alias("n"))


@query("src_station_master", """
SELECT 8000000 + s_suppkey AS eva, true AS is_main, s_suppkey AS station_number,
  s_name AS stada_name, cast(s_suppkey % 7 AS bigint) AS category,
  concat('L', s_nationkey) AS federal_state,
  CASE WHEN s_suppkey % 13 <> 0 THEN 6.0::double + s_suppkey % 9 END AS longitude,
  CASE WHEN s_suppkey % 13 <> 0 THEN 47.0::double + s_suppkey % 8 END AS latitude
FROM supplier
UNION ALL
SELECT 9000000 + s_suppkey, false, s_suppkey, s_name, cast(s_suppkey % 7 AS bigint),
  concat('L', s_nationkey), NULL, NULL FROM supplier
""")
def _src_station_master(spark, sf):
    """Nested station files, a thousand stations in each, written as JSON and read back."""
    path = scratch_dir(spark, "master")
    entries = master_entries(frames.table(spark, sf, "supplier"))
    entries.groupBy(F.expr("number div 1000").alias("file")).agg(
        F.collect_list(F.struct(*entries.columns)).alias("result")).select("result") \
        .write.option("maxRecordsPerFile", 1).json(path)
    return files.station_master(spark, path)


@query("src_reference_json", using("stations", "geometry", body=f"""
SELECT s.station_eva, s.station_name, s.latitude, s.coordinate_source,
  cast(s.category AS bigint) AS category, count(g.vec_id) AS tracks,
  cast(coalesce(sum(len(g.coordinates)), 0) AS bigint) AS points
FROM stations s LEFT JOIN geometry g ON g.from_station = s.station_name
GROUP BY 1, 2, 3, 4, 5
"""))
def _src_reference_json(spark, sf):
    """The station dimension and the track geometry through their JSON files."""
    dim, tracks = scratch_dir(spark, "stations"), scratch_dir(spark, "geometry")
    frames.stations(spark, sf).write.json(dim)
    geometry(spark, sf).select(
        "from_station", "to_station", (F.col("metres") / 1000).alias("track_km"), "coordinates"
    ).write.json(tracks)
    counted = files.segment_geometry(spark, tracks).groupBy("from_station").agg(
        F.count(F.lit(1)).alias("tracks"), F.sum(F.size("coordinates")).alias("points"))
    joined_rows = files.station_dimension(spark, dim).join(
        counted, F.col("station_name") == F.col("from_station"), "left")
    return joined_rows.select(
        "station_eva", "station_name", "latitude", "coordinate_source", "category",
        F.coalesce("tracks", F.lit(0)).alias("tracks"),
        F.coalesce("points", F.lit(0)).alias("points"))


@query("sink_gold_overwrite", using("stops", body=f"""
SELECT stop_id, trip_id, stop_index, {joined("full_route")} AS full_route, service_date,
  cast(substr(service_date, 1, 4) AS bigint) AS year FROM stops
"""))
def _sink_gold_overwrite(spark, sf):
    """The stop table written twice; the second write replaces the first and its schema."""
    database = _database(spark)
    table = stops(spark, sf).withColumn("year", F.year("service_date"))
    sinks.overwrite_table(table.select("stop_id", "service_date"), f"{database}.stop")
    sinks.overwrite_table(
        table.select("stop_id", "trip_id", "stop_index", "full_route", "service_date", "year"),
        f"{database}.stop", partition_by=["year"])
    return spark.table(f"{database}.stop")


def _database(spark) -> str:
    name = f"gold_{uuid.uuid4().hex}"
    sinks.create_database(spark, name)
    return name


@query("sink_jsonl_daily", """
SELECT strftime(ts, '%Y-%m-%d') AS dt, cast(count(*) * 2 AS bigint) AS lines,
  cast(count(*) FILTER (WHERE user_id % 3 = 0) * 2 AS bigint) AS null_contents
FROM events GROUP BY 1
""")
def _sink_jsonl_daily(spark, sf):
    """Two appended writes, counted per day; NULL fields are written out."""
    path = scratch_dir(spark, "jsonl")
    rows = frames.table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 3 != 0, F.col("event_type")).alias("content"),
        F.col("ts").alias("observed_at"))
    for _ in range(2):
        sinks.append_jsonl_daily(rows, path)
    return spark.read.schema("value STRING, dt STRING").text(path).groupBy("dt").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("value").contains('"content":null')).alias("null_contents"))


@query("sink_kafka", using("f", body=f"""
SELECT stop_id AS key, {text("observed_at - INTERVAL 2 HOUR")} AS observed_at, station_eva,
  brand, 'schema_version=1' AS header
FROM f
"""))
def _sink_kafka(spark, sf):
    """The messages as they are handed to the connector, decoded again."""
    messages = kafka.as_messages(frames.payloads(spark, sf))
    value = F.from_json(F.col("value").cast("string"), files.S.PAYLOAD)
    header = F.get("headers", F.lit(0))
    return messages.select(F.col("key").cast("string").alias("key"), value.alias("obs"),
                           F.concat(header["key"], F.lit("="), header["value"].cast("string"))
                           .alias("header")).select(
        "key", F.try_to_timestamp("obs.observed_at").alias("observed_at"),
        "obs.station_eva", "obs.brand", "header")


@query("gold_tables", using("trips", body="""
SELECT service_date, is_long_distance, count(*) AS trips,
  cast(sum(observed_stop_count) AS bigint) AS stops,
  cast(count(*) FILTER (WHERE any_stop_cancelled) AS bigint) AS cancelled
FROM trips GROUP BY 1, 2
"""))
def _gold_tables(spark, sf):
    """Trips from a stop table stored by trip hash: read without a shuffle up to the sums."""
    table, buckets = f"{_database(spark)}.stop", shuffle_width(spark)
    gold.save_stops(gold.stop_table(frames.observations(spark, sf), partitions=buckets), table,
                    buckets=buckets)
    return gold.trip_table(spark.table(table)) \
        .groupBy("service_date", "is_long_distance").agg(
            F.count(F.lit(1)).alias("trips"), F.sum("observed_stop_count").alias("stops"),
            F.count_if("any_stop_cancelled").alias("cancelled"))


# Rows of each Gold table, and the sum of one of its numbers.
_GOLD_SUMS = {
    "stop": "stop_index", "trip": "observed_stop_count", "daily_route": "trips_observed",
    "station": "route_calls", "segment": "trips", "station_pair": "direct_trains",
    "segment_geometry": "geometry_points", "segment_point": "point_index",
}


@query("gold_build", using("trips", "segments", "pairs", "geometry", "stations", body="""
WITH daily AS (SELECT count(*) AS n FROM trips WHERE is_long_distance
  GROUP BY service_date, origin, destination),
tracks AS (SELECT len(coordinates) AS points FROM geometry g JOIN segments s
  ON s.from_station = g.from_station AND s.to_station = g.to_station AND s.hops = 1),
sampled AS (SELECT cast(ceil(points / greatest(1, floor(points / 60))) AS bigint) AS k FROM tracks)
SELECT 'stop' AS name, count(*) AS rows, cast(sum(stop_index) AS bigint) AS total FROM stops
UNION ALL SELECT 'trip', count(*), cast(sum(observed_stop_count) AS bigint) FROM trips
UNION ALL SELECT 'daily_route', count(*), cast(sum(n) AS bigint) FROM daily
UNION ALL SELECT 'station', count(*), cast(sum(s_suppkey % 50) AS bigint) FROM supplier
UNION ALL SELECT 'segment', count(*), cast(sum(trips) AS bigint) FROM segments
UNION ALL SELECT 'station_pair', count(*), cast(sum(direct_trains) AS bigint) FROM pairs
UNION ALL SELECT 'segment_geometry', count(*), cast(coalesce(sum(points), 0) AS bigint) FROM tracks
UNION ALL SELECT 'segment_point', cast(coalesce(sum(k), 0) AS bigint),
  cast(coalesce(sum(k * (k - 1) // 2), 0) AS bigint) FROM sampled
"""))
def _gold_build(spark, sf):
    """All eight tables in one build, with its rules enforced; some rows here are round trips."""
    database = f"gold_{uuid.uuid4().hex}"
    tracks = geometry(spark, sf).withColumn("track_km", F.round(F.col("metres") / 1000, 1))
    gold.build_gold(frames.observations(spark, sf), frames.stations(spark, sf), database,
                    buckets=shuffle_width(spark), tracks=tracks, circular=False)
    return stack([
        spark.table(f"{database}.{name}").agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(number), F.lit(0)).cast("long").alias("total"))
        .select(F.lit(name).alias("name"), "rows", "total")
        for name, number in _GOLD_SUMS.items()])
