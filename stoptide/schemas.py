"""Declared schemas. Nothing in this package infers one.

Schemas whose fields are walked in code are types; the others are DDL texts, which every
reader and parser takes as they are and which need no running session.
"""

from __future__ import annotations

from pyspark.sql import types as T


# One landed record: the columns the Kafka source produces, the value left unparsed.
# The corrupt-record column has to be declared, or malformed lines are dropped. All columns
# are declared nullable, also those that must not be NULL: readers do not enforce the
# declaration, but the optimizer trusts it and would remove the test that finds such rows.
RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])
RECORD_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value"]
RECORD_REQUIRED = ["topic", "partition", "offset", "value"]

BRONZE = T.StructType([
    *RECORD.fields,
    T.StructField("_source_file", T.StringType()),
    T.StructField("_bronze_ingested_at", T.TimestampType()),
])

# The names and types of the observation payload are the producer's.
PAYLOAD = T.StructType([
    T.StructField("stop_id", T.StringType()),
    T.StructField("station_eva", T.LongType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("start_datetime", T.StringType()),
    T.StructField("stop_index", T.IntegerType()),
    T.StructField("train_category", T.StringType()),
    T.StructField("train_number", T.StringType()),
    T.StructField("train_operator", T.StringType()),
    T.StructField("train_filter", T.StringType()),
    T.StructField("planned_arrival", T.StringType()),
    T.StructField("changed_arrival", T.StringType()),
    T.StructField("planned_departure", T.StringType()),
    T.StructField("changed_departure", T.StringType()),
    T.StructField("planned_arrival_platform", T.StringType()),
    T.StructField("planned_departure_platform", T.StringType()),
    T.StructField("changed_arrival_platform", T.StringType()),
    T.StructField("changed_departure_platform", T.StringType()),
    T.StructField("planned_path_from", T.StringType()),
    T.StructField("planned_path_to", T.StringType()),
    T.StructField("changed_path_from", T.StringType()),
    T.StructField("changed_path_to", T.StringType()),
    T.StructField("arrival_status", T.StringType()),
    T.StructField("departure_status", T.StringType()),
    T.StructField("cancelled_at", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("messages", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("observed_at", T.StringType()),
])

# Names of the plan's and the change's fields in the payload.
PLAN_FIELDS = [
    "train_category", "train_number", "train_operator", "train_filter",
    "planned_arrival", "planned_departure",
    "planned_arrival_platform", "planned_departure_platform",
    "planned_path_from", "planned_path_to",
]
CHANGE_FIELDS = [
    "changed_arrival", "changed_departure",
    "changed_arrival_platform", "changed_departure_platform",
    "changed_path_from", "changed_path_to",
    "arrival_status", "departure_status", "cancelled_at", "messages",
]

# Elements and attributes of timetable documents. Attributes carry the prefix "_". The corrupt-record field tells a
# document that breaks off from one without stops.
_MESSAGE = "STRUCT<_t: STRING, _c: STRING, _cat: STRING>"
PLAN_DOCUMENT = """
    _station STRING,
    s ARRAY<STRUCT<
        _id: STRING,
        tl: STRUCT<_f: STRING, _t: STRING, _o: STRING, _c: STRING, _n: STRING>,
        ar: STRUCT<_pt: STRING, _pp: STRING, _ppth: STRING>,
        dp: STRUCT<_pt: STRING, _pp: STRING, _ppth: STRING>>>,
    _corrupt_record STRING
    """
CHANGE_DOCUMENT = f"""
    _station STRING, _eva STRING,
    s ARRAY<STRUCT<
        _id: STRING, _eva: STRING,
        ar: STRUCT<_ct: STRING, _cp: STRING, _cpth: STRING, _cs: STRING, _clt: STRING,
                   _fb: STRING, m: ARRAY<{_MESSAGE}>>,
        dp: STRUCT<_ct: STRING, _cp: STRING, _cpth: STRING, _cs: STRING, _clt: STRING,
                   _fb: STRING, m: ARRAY<{_MESSAGE}>>,
        m: ARRAY<{_MESSAGE}>>>,
    _corrupt_record STRING
    """

STATION = """
    station_eva BIGINT, station_name STRING, stada_name STRING,
    latitude DOUBLE, longitude DOUBLE, coordinate_source STRING,
    category INT, federal_state STRING, route_calls BIGINT
    """
_EVA = """STRUCT<number: BIGINT, isMain: BOOLEAN,
    geographicCoordinates: STRUCT<coordinates: ARRAY<DOUBLE>>>"""
STATION_MASTER_ENTRY = f"""
    number: BIGINT, name: STRING, category: INT, federalState: STRING,
    evaNumbers: ARRAY<{_EVA}>
    """
STATION_MASTER = f"result ARRAY<STRUCT<{STATION_MASTER_ENTRY}>>"
SEGMENT_GEOMETRY = """
    from_station STRING, to_station STRING, track_km DOUBLE,
    coordinates ARRAY<ARRAY<DOUBLE>>
    """

def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column names of static timetable tables, as the format has them; all texts.
GTFS = {
    "calendar": _texts(
        "service_id", "start_date", "end_date", "monday", "tuesday",
        "wednesday", "thursday", "friday", "saturday", "sunday"),
    "calendar_dates": _texts("service_id", "date", "exception_type"),
    "trips": _texts("route_id", "service_id", "trip_id"),
    "routes": _texts("route_id", "agency_id", "route_short_name"),
    "agency": _texts("agency_id", "agency_name"),
    "stops": _texts("stop_id"),
    "stop_times": _texts(
        "trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time",
        ),
}

ALERT = """
    cause STRING, effect STRING, severity STRING,
    has_informed_entity BOOLEAN, has_active_period BOOLEAN, has_header BOOLEAN,
    has_description BOOLEAN, has_url BOOLEAN,
    entities ARRAY<STRUCT<agency_id: STRING, route_id: STRING, stop_id: STRING,
                          trip_id: STRING>>,
    texts ARRAY<STRING>
    """
