from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stoptide import schemas as S
from stoptide.operators.latest import first_with_count, main_eva
from stoptide.operators.ranks import (
    discrete_quantiles,
    most_common,
    running_total,
    value_counts,
)
from stoptide.operators.reconcile import (
    fingerprint_matches,
    reconcile_ids,
    stop_sequences,
)
from stoptide.plans import feed, stations, timetable
from stoptide.sources import files
from tests.conftest import one, rows

# Trips "n1" over midnight with stops out of order, "k4" with one stop, "w2" without times.
STOP_TIMES = [
    ("n1", "30", "C", "25:05:00", "25:05:00"), ("n1", "4", "A", "22:58:30", "23:00:00"),
    ("n1", "12", "B", "23:44:00", "23:46:00"), ("k4", "1", "D", "06:15:00", "06:20:00"),
    ("w2", "1", "A", None, None), ("w2", "2", "B", "", ""),
    ("m7", "5", "B", "06:40:00", ""), ("m7", "2", "A", "", "05:30:00")]


def stop_times(spark):
    return spark.createDataFrame(STOP_TIMES, S.GTFS["stop_times"])


@pytest.fixture(scope="module")
def calendar(spark):
    """Weekdays in June, weekends in June, and a service that only has exceptions."""
    work, rest = [*["1"] * 5, "0", "0"], [*["0"] * 5, "1", "1"]
    base = spark.createDataFrame(
        [("work", "20270601", "20270630", *work), ("rest", "20270601", "20270630", *rest)],
        S.GTFS["calendar"])
    dates = spark.createDataFrame(
        [("work", "20270617", "2", 1), ("rest", "20270617", "1", 2),        # a holiday
         ("extra", "20270612", "1", 3), ("extra", "20270705", "1", 4),
         ("work", "20270621", "1", 5), ("work", "20270621", "2", 6),        # the last one counts
         ("rest", "20270621", "7", 7)],                                     # no such type
        "service_id STRING, date STRING, exception_type STRING, line INT")
    return base, dates


@pytest.mark.parametrize("date, services", [
    ("20270616", ["work"]), ("20270617", ["rest"]), ("20270612", ["extra", "rest"]),
    ("20270621", []), ("20270705", ["extra"]), ("20270531", []), ("20270630", ["work"])])
def test_active_services(calendar, date, services):
    got = timetable.active_services(*calendar, date, order="line")
    assert [r[0] for r in rows(got)] == services


def test_stop_order_comes_from_the_sequence(spark):
    numbered = stop_times(spark).withColumn("stop_sequence", F.col("stop_sequence").cast("int"))
    got = {r.trip_id: r.stops for r in stop_sequences(numbered).collect()}
    assert (got["n1"], got["m7"]) == (["A", "B", "C"], ["A", "B"])


def test_time_spans(spark):
    got = {r[0]: tuple(r)[1:] for r in timetable.trip_time_spans(stop_times(spark)).collect()}
    assert got["n1"] == ("23:00:00", "25:05:00")
    assert got["k4"] == ("06:20:00", "06:20:00")
    assert got["m7"] == ("05:30:00", "06:40:00")
    assert got.get("w2", (None, None)) == (None, None)


@pytest.mark.parametrize("span, now, overnight, state", [
    (("09:00:00", "10:01:00"), "09:30:00", False, "running"),
    (("09:00:00", "10:01:00"), "10:02:00", False, "already finished"),
    (("09:00:00", "10:01:00"), "08:00:00", False, "not yet started"),
    ((None, None), "08:00:00", False, "already finished"),
    (("23:00:00", "25:30:00"), "00:30:00", False, "not yet started"),
    (("23:00:00", "25:30:00"), "00:30:00", True, "running"),
    (("23:00:00", "25:30:00"), "12:00:00", True, "not yet started"),
])
def test_trip_state(spark, span, now, overnight, state):
    df = spark.createDataFrame([span], "a STRING, b STRING")
    assert one(df.select(timetable.trip_state(
        F.col("a"), F.col("b"), F.lit(now), overnight).alias("s"))).s == state


def test_coverage(spark, calendar):
    trips = spark.createDataFrame(
        [("L1", "work", "n1"), ("L1", "work", "k4"), ("L2", "work", "m7"), ("L2", "rest", "w2"),
         ("L3", "extra", "zz")], S.GTFS["trips"])
    routes = spark.createDataFrame(
        [("L1", "north", "NJ"), ("L2", "coast", "RE"), ("L3", "north", "EC")], S.GTFS["routes"])
    agency = spark.createDataFrame([("north", "Northern Nights")], S.GTFS["agency"])
    feed_ids = spark.createDataFrame([("k4",), ("m7",), ("gone",), ("m7",)], "trip_id STRING")
    active = timetable.active_services(*calendar, "20270616", order="line")
    coverage = timetable.trip_coverage(
        trips, routes, timetable.trip_time_spans(stop_times(spark)), active, feed_ids,
        F.lit("06:20:00"))
    got = {r.state: (r.covered, r.total, r.agency_covered, r.agency_total)
           for r in timetable.coverage_by_state(coverage, "north").collect()}
    assert got == {"running": (2, 2, 1, 1), "not yet started": (0, 1, 0, 1)}
    assert rows(timetable.running_by_agency(coverage, agency), "agency_id", "agency_name",
                "covered", "total") == [
        ("coast", "?", 1, 1), ("north", "Northern Nights", 1, 1)]
    assert rows(timetable.matched_breakdown(trips, routes, agency, feed_ids)) == [
        ("coast", "?", "RE", "L2", 1), ("north", "Northern Nights", "NJ", "L1", 1)]


def test_match_classes_and_fingerprints(spark):
    schema = "trip_id STRING, stops ARRAY<STRING>"
    fed = spark.createDataFrame(
        [("a", ["x", "y"]), ("b", ["y"]), ("c", ["q"]), ("d", ["x", "q"]), ("e", []),
         ("f", ["x"])], schema)
    static = spark.createDataFrame(
        [("a", ["x", "y"]), ("b", ["x", "y"]), ("c", ["x", "y"]), ("d", ["x", "y"]),
         ("e", ["x"])], schema)
    assert rows(timetable.match_classes(fed, static)) == [
        ("a", "exact"), ("b", "subset"), ("c", "disjoint"), ("d", "other"), ("e", "disjoint"),
        ("f", "disjoint")]
    assert rows(fingerprint_matches(fed, static), "trip_id") == [("a",), ("f",)]


def test_reconcile(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id INT")
    right = spark.createDataFrame([(2,), (3,), (4,)], "id INT")
    row = one(reconcile_ids(left, right, "id"))
    assert (row.matched, row.only_left, row.only_right, row.pct_of_left) == (1, 1, 2, 50.0)
    empty = one(reconcile_ids(left.limit(0), right.limit(0), "id"))
    assert (empty.matched, empty.pct_of_left) == (0, None)


def test_running_total_over_the_whole_integer_range(spark):
    keys = [None, -2**31, -70_000, -1, 0, 1, 65_535, 65_536, 2**31 - 1]
    df = spark.createDataFrame([(k, i + 1) for i, k in enumerate(keys)], "k INT, n BIGINT")
    got = {r.k: r.running for r in running_total(df, "k").collect()}
    total, want = 0, {}
    for key in sorted(k for k in keys if k is not None):
        total += keys.index(key) + 1
        want[key] = total
    want[None] = total + 1
    assert got == want


@pytest.mark.parametrize("base", [0, 2**32, 2**40, -2**63])
def test_running_total_of_wide_keys(spark, base):
    keys = [None, *(base + k for k in (0, 1, 5, 65_536, 2**32, 2**33 + 5, 2**48))]
    df = spark.createDataFrame([(k, 2 * i + 1) for i, k in enumerate(keys)], "k BIGINT, n BIGINT")
    got = {r.k: r.running for r in running_total(df, "k").collect()}
    assert [got[k] for k in keys[1:]] == [3, 8, 15, 24, 35, 48, 63]
    assert got[None] == 64


def test_running_total_refuses_other_keys(spark):
    for kind in ("DOUBLE", "STRING", "DECIMAL(10,0)"):
        with pytest.raises(TypeError, match="integer key"):
            running_total(spark.createDataFrame([], f"k {kind}, n BIGINT"), "k")


def test_discrete_quantiles_against_the_sorted_list(spark):
    values = [((i * 7919) % 4001 - 2000) * (1 if i % 3 else 50) for i in range(997)]
    values += [17] * 500
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v INT")
    points = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    ordered = sorted(values)
    want = {p: ordered[int(p * (len(values) - 1))] for p in points}
    assert {r.point: r.value for r in discrete_quantiles(df, "v", points).collect()} == want
    assert discrete_quantiles(df.limit(0), "v", points).count() == 0


def test_value_counts_and_most_common(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v STRING")
    assert rows(value_counts(df, "v")) == [("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)]
    assert [tuple(r) for r in most_common(df, "v", 2).collect()] == [("a", 2), ("b", 1)]


def test_presence_counts_empty_text_as_absent(spark):
    df = spark.createDataFrame(
        [("1", "", 0), ("2", None, None), ("", "x", 5)], "trip_id STRING, route_id STRING, "
        "direction_id INT")
    got = rows(feed.field_presence(df, ["trip_id", "route_id", "direction_id"]),
               "field", "present", "total")
    assert got == [("direction_id", 2, 3), ("route_id", 1, 3), ("trip_id", 2, 3)]


def test_identity(spark):
    df = spark.createDataFrame(
        [("u", "20270102"), ("u", "20270101"), ("v", "20270101"), ("v", "20270101"),
         ("w", None)], "trip_id STRING, start_date STRING")
    row = one(feed.identity_profile(df))
    assert tuple(row)[:4] == (3, 4, 1, 2)
    assert row.start_dates == ["20270101=3", "20270102=1", "=1"] or \
        row.start_dates == ["=1", "20270101=3", "20270102=1"]
    assert one(feed.identity_profile(df.limit(0))).start_dates == []


def test_alerts(spark):
    def entity(**given):
        return {"agency_id": None, "route_id": None, "stop_id": None, "trip_id": None} | given

    def alert(cause, flags, entities, texts):
        return (cause, "DETOUR", None, *flags, entities, texts)

    df = spark.createDataFrame([
        alert("WEATHER", (True, True, None, True, False),
              [entity(route_id="r", trip_id=""), entity(trip_id="t"), entity(agency_id="")],
              ["fog", "ice"]),
        alert("WEATHER", (True, False, False, False, False), [entity(route_id="q")], None),
        alert("POLICE", (False, False, False, True, False), None, ["ice"]),
        alert(None, (None,) * 5, [], [])], S.ALERT)
    got = {(r.section, r.label): (r.n, r.pct) for r in feed.alert_profile(df).collect()}
    assert got[("presence", "has_informed_entity")] == (2, 50.0)
    assert got[("presence", "has_header")] == (0, 0.0) == got[("presence", "has_url")]
    assert got[("presence", "has_description")] == (2, 50.0)
    assert {k[1]: v[0] for k, v in got.items() if k[0] == "selector"} == {
        "route_id": 2, "trip_id": 1, "trip without id": 1}
    assert got[("cause", "WEATHER")] == (2, None) and got[("cause", None)][0] == 1
    assert got[("text", "ice")][0] == 2 and got[("distinct_texts", "")][0] == 2


def test_alert_limits_leave_flags_and_selectors_alone(spark):
    rows_ = [(f"C{i}", "E", "S", *[True] * 5,
              [dict.fromkeys(("agency_id", "route_id", "stop_id", "trip_id"), "x")],
              [f"t{i}"]) for i in range(9)]
    listed = feed.alert_profile(spark.createDataFrame(rows_, S.ALERT), top_values=2, top_texts=1)
    n = {r["section"]: r["count"] for r in listed.groupBy("section").count().collect()}
    assert n == {"presence": 5, "selector": 4, "cause": 2, "effect": 1, "severity": 1, "text": 1,
                 "distinct_texts": 1}


def test_route_calls(spark):
    df = spark.createDataFrame(
        [("F", "A|B||", "C"), ("F", None, "A"), ("N", "A", "A"), (None, "A", None)],
        "train_filter STRING, planned_path_from STRING, planned_path_to STRING")
    assert rows(stations.route_call_counts(df)) == [("A", 2), ("B", 1), ("C", 1)]


def test_category_rollup_has_the_unknown_last(spark):
    df = spark.createDataFrame([(2,), (1,), (2,), (None,)], "category INT")
    assert rows(stations.category_rollup(df)) == [(1, 1, 1), (2, 2, 3), (None, 1, 4)]


def test_first_candidate_with_trains(spark):
    names = spark.createDataFrame(
        [("Berlin", [8003200, 8003201]), ("Nowhere", [1, 2]), ("Fulda", [5])],
        "name STRING, candidates ARRAY<BIGINT>")
    counts = spark.createDataFrame([(8003200, 0), (8003201, 7), (5, 1)], "eva BIGINT, calls INT")
    assert rows(first_with_count(names, counts), "name", "eva") == [
        ("Berlin", 8003201), ("Fulda", 5)]


MASTER = """{"result": [
 {"number": 1, "name": "Ulm Hbf", "category": 1, "federalState": "BW",
  "evaNumbers": [
   {"number": 8000170, "isMain": true,
    "geographicCoordinates": {"type": "Point", "coordinates": [9.98, 48.39]}},
   {"number": 8098170, "isMain": false}]},
 {"number": 2, "name": "Halt", "category": 7, "federalState": "BW", "evaNumbers": []}]}"""


def test_station_dimension(spark, tmp_path):
    (tmp_path / "m.json").write_text(MASTER)
    master = files.station_master(spark, str(tmp_path / "m.json"))
    assert rows(master, "eva", "is_main", "latitude") == [
        (8000170, True, 48.39), (8098170, False, None)]
    targets = spark.createDataFrame(
        [(8000170, "Ulm Hbf"), (8500010, "Basel SBB"), (8098170, "tief"), (5, "?")],
        "eva BIGINT, name STRING").select(
        "*", F.lit("n").alias("stada_name"), F.lit(1).alias("category"),
        F.lit("H").alias("federal_state"), F.lit(3).alias("route_calls"))
    dim = stations.station_dimension(targets, master, stations.manual_coordinates(spark))
    assert rows(dim, "station_name", "latitude", "longitude", "coordinate_source") == [
        ("?", None, None, "missing"), ("Basel SBB", 47.5474, 7.5898, "manual"),
        ("Ulm Hbf", 48.39, 9.98, "stada"), ("tief", None, None, "missing")]


def test_seed_stations_take_the_main_number(spark, tmp_path):
    (tmp_path / "m.json").write_text(MASTER)
    whole = spark.read.schema(S.STATION_MASTER).option("multiLine", True) \
        .json(str(tmp_path / "m.json")).select(F.inline("result"))
    assert rows(stations.seed_stations(whole)) == [(8000170,)]
    assert rows(whole.select("number", main_eva(F.col("evaNumbers")))) == [
        (1, 8000170), (2, None)]


def test_csv_tables_tolerate_a_byte_order_mark(spark, tmp_path):
    (tmp_path / "trips.txt").write_bytes(
        "﻿trip_id,route_id,extra,service_id\nt1,r1,x,007\n".encode())
    got = files.gtfs_table(spark, str(tmp_path / "trips.txt"), "trips")
    assert rows(got) == [("r1", "007", "t1")]
    (tmp_path / "bad.txt").write_text("trip_id\nt1\n")
    with pytest.raises(ValueError, match="lacks"):
        files.gtfs_table(spark, str(tmp_path / "bad.txt"), "trips")
