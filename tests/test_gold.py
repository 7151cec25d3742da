from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stoptide import schemas as S
from stoptide.operators.latest import last_observation
from stoptide.plans import checks, geometry, gold
from tests.conftest import one, plan_text, rows

T0 = dt.datetime(2026, 5, 10, 6, 0)
SCHEMA = """stop_id STRING, trip_id STRING, start_at TIMESTAMP, stop_index INT,
    station_eva BIGINT, station_name STRING, train_category STRING, train_number STRING,
    train_operator STRING, brand STRING, path_from ARRAY<STRING>, path_to ARRAY<STRING>,
    planned_arrival_at TIMESTAMP, changed_arrival_at TIMESTAMP,
    planned_departure_at TIMESTAMP, changed_departure_at TIMESTAMP,
    arrival_delay_minutes INT, departure_delay_minutes INT, is_cancelled BOOLEAN,
    observed_at TIMESTAMP, kafka_offset BIGINT"""


def stop(trip, index, station, arr=None, dep=None, *, category="ICE", cancelled=False,
         path_from=None, path_to=None, seen=0, offset=0, start=T0):
    planned = T0 + dt.timedelta(hours=index)

    def shifted(delay):
        return None if delay is None else planned + dt.timedelta(minutes=delay)

    return (f"{trip}-2605100600-{index}", trip, start, index, index, station, category, "1", "80",
            None, path_from, path_to, planned, shifted(arr), planned, shifted(dep), arr, dep,
            cancelled, T0 + dt.timedelta(minutes=seen), offset)


def observed(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stops_of(spark, *data):
    return gold.stop_table(observed(spark, *data))


def test_only_the_last_observation_counts(spark):
    df = observed(spark, stop("t", 1, "A", 24, seen=1), stop("t", 1, "A", 23, seen=3),
                  stop("t", 1, "A", 25, seen=2))
    assert rows(last_observation(df), "arrival_delay_minutes") == [(23,)]


def test_equal_times_are_decided_by_the_offset(spark):
    df = observed(spark, stop("t", 1, "A", 1, offset=5), stop("t", 1, "A", 2, offset=9))
    assert rows(last_observation(df), "arrival_delay_minutes") == [(2,)]


def test_a_real_route_beats_a_stub_in_the_same_trip(spark):
    table = stops_of(spark, stop("t", 1, "A"), stop("t", 2, "B", path_from=["A"], path_to=["C"]),
                     stop("u", 1, "X"))
    got = {r.stop_id: (r.full_route, r.origin, r.destination) for r in table.collect()}
    assert got["t-2605100600-1"] == (["A", "B", "C"], "A", "C")
    assert got["u-2605100600-1"] == (["X"], None, None)


def test_delay_change_uses_the_previous_observed_stop(spark):
    table = stops_of(spark, stop("t", 1, "A", 2, 5), stop("t", 4, "B", 9, None),
                     stop("t", 7, "C", None, None), stop("t", 9, "D", 3, 3))
    assert rows(table, "stop_index", "delay_change_vs_previous_observed_stop") == \
        [(1, None), (4, 4), (7, None), (9, None)]


def test_trip_row_comes_from_its_ends(spark):
    table = stops_of(spark, stop("t", 3, "C", 10, 11), stop("t", 1, "A", None, 4),
                     stop("t", 2, "B", 1, 1, cancelled=True))
    row = one(gold.trip_table(table))
    assert (row.first_observed_station, row.last_observed_station) == ("A", "C")
    assert (row.departure_delay_at_first_observed, row.arrival_delay_at_last_observed,
            row.delay_change_over_observed_span) == (4, 10, 6)
    assert (row.observed_stop_count, row.any_stop_cancelled) == (3, True)


def test_unidentified_first_stop(spark):
    table = stops_of(spark, stop("t", 1, "A", category=None), stop("t", 2, "B", 7))
    assert one(gold.trip_table(table)).is_long_distance is None
    assert gold.daily_route_table(gold.trip_table(table)).count() == 0
    assert one(gold.trip_table(table, identity="any")).is_long_distance is True


def test_missing_delay_is_never_on_time(spark):
    route = {"path_to": ["Z"]}
    table = stops_of(spark, stop("a", 1, "A", None, **route), stop("b", 1, "A", 3, **route),
                     stop("c", 1, "A", 20, **route), stop("d", 1, "A", 40, cancelled=True, **route),
                     stop("r", 1, "A", 0, category="RE", **route))
    row = one(gold.daily_route_table(gold.trip_table(table)))
    assert (row.trips_observed, row.origin, row.destination) == (4, "A", "Z")
    assert row.avg_arrival_delay_minutes == pytest.approx(21.0)
    assert row.pct_within_5_min == pytest.approx(100 / 3)
    assert row.pct_over_15_min == pytest.approx(200 / 3)
    assert row.cancellation_rate == pytest.approx(25.0)
    row = one(gold.daily_route_table(gold.trip_table(table), exclude_cancelled=True))
    assert row.avg_arrival_delay_minutes == pytest.approx(11.5)
    assert (row.trips_observed, row.cancellation_rate) == (4, 25.0)


def test_segments_skip_cancelled_and_unknown_ends(spark):
    stations = spark.createDataFrame(
        [("A", 1.0, 2.0), ("B", 3.0, 4.0)],
        "station_name STRING, latitude DOUBLE, longitude DOUBLE")
    table = stops_of(
        spark, stop("t", 1, "A", 2), stop("t", 2, "B", 5), stop("t", 4, "C", 1),
        stop("u", 1, "A", 2), stop("u", 2, "B", 9, cancelled=True), stop("u", 3, "C", 4),
        stop("v", 1, "A", None), stop("v", 2, "B", 3),
        stop("r", 1, "A", 0, category="RE"), stop("r", 2, "B", 50, category="RE"))
    segments = gold.segment_table(table, stations)
    got = rows(segments, "from_station", "to_station", "hops", "trips",
               "avg_delay_gained_minutes", "trips_losing_time", "from_latitude", "to_longitude")
    assert got == [("A", "B", 1, 1, 3.0, 1, 1.0, 4.0), ("B", "C", 2, 1, -4.0, 0, 3.0, None)]


def brute_pairs(data):
    latest = {}
    for s in data:
        if s[0] not in latest or (s[19], s[20]) > (latest[s[0]][19], latest[s[0]][20]):
            latest[s[0]] = s
    trips = defaultdict(list)
    for s in latest.values():
        if s[6] == "ICE" and s[2] is not None:
            trips[(s[1], s[2])].append(s)
    found = defaultdict(list)
    for members in trips.values():
        for a in members:
            for b in members:
                if a[3] < b[3] and not a[18] and not b[18] and b[16] is not None \
                        and a[17] is not None:
                    found[(a[5], b[5])].append((b[16], b[16] - a[17]))
    return {k: (len(v), round(sum(d for d, _ in v) / len(v), 1)) for k, v in found.items()}


def test_pairs_against_brute_force(spark):
    rng = random.Random(11)
    data = []
    for trip in range(25):
        start = None if trip == 7 else T0
        for _ in range(40 if trip == 0 else 6):
            index = rng.randrange(1, 30 if trip == 0 else 8)
            delay = rng.choice([None, *range(-3, 30)])
            data.append(stop(f"t{trip}", index, f"S{index % 6}", delay, rng.choice([None, 1, 5]),
                             cancelled=rng.random() < 0.1, seen=len(data), offset=len(data),
                             category=rng.choice(["ICE", "ICE", "RE"]), start=start))
    pairs = gold.station_pair_table(stops_of(spark, *data))
    got = {(r.from_station, r.to_station): (r.direct_trains, r.avg_arrival_delay_minutes)
           for r in pairs.collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in brute_pairs(data).items()}
    for key, (_, delay) in brute_pairs(data).items():
        assert got[key][1] == pytest.approx(delay, abs=0.11)


def test_a_stop_that_holds_a_third_of_all_rows(spark):
    data = [stop("hot", 1, "A", i % 50, seen=i, offset=i) for i in range(500)]
    data += [stop(f"t{i}", 1 + i % 3, "B", i, seen=i, offset=i) for i in range(1000)]
    table = stops_of(spark, *data)
    assert table.count() == 1001
    assert one(table.filter("trip_id = 'hot'")).arrival_delay_minutes == 499 % 50


def test_rows_without_a_trip_id_do_not_form_one_trip(spark):
    nameless = [(f"9{i}-2605100600-1", None, *stop("x", 1, "A", i)[2:]) for i in range(5)]
    broken = [("oddity", None, *stop("x", 1, "B", 1)[2:])]
    table = stops_of(spark, *nameless, *broken)
    assert rows(table, "trip_id") == [("90",), ("91",), ("92",), ("93",), ("94",), ("oddity",)]
    assert table.filter("delay_change_vs_previous_observed_stop IS NOT NULL").count() == 0


def test_trips_longer_than_any_train_are_refused(spark):
    table = stops_of(spark, *[stop("t", i, f"S{i}", 1, 1) for i in range(1, 6)])
    assert one(checks.check_trip_length(table, most=5)).status == "PASS"
    with pytest.raises(checks.DataQualityError, match="trip length"):
        checks.enforce(checks.check_trip_length(table, most=4))


def test_rows_are_collapsed_before_the_shuffle_and_trips_sorted_once(spark):
    table = stops_of(spark, stop("t", 1, "A", 2), stop("t", 2, "B", 5))
    text = plan_text(table)
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning(stop_id")[1]
    assert text.count("Exchange hashpartitioning") == 2
    pairs = plan_text(gold.station_pair_table(table, approximate_distinct=True))
    assert pairs.count("Exchange hashpartitioning") == 3
    assert "Join" not in pairs


def test_distinct_counts_do_not_expand_the_pairs(spark):
    other = T0 + dt.timedelta(days=1)
    data = []
    for trip, number, start in (("a", "1", T0), ("b", "1", other), ("c", None, other)):
        for k, name in enumerate("AB", 1):
            row = list(stop(trip, k, name, 1, 2, start=start))
            row[7] = number
            row[12], row[14] = (x + (start - T0) for x in (row[12], row[14]))
            data.append(tuple(row))
    pairs = gold.station_pair_table(stops_of(spark, *data))
    assert "Expand" not in plan_text(pairs)
    assert plan_text(pairs).count("Exchange hashpartitioning") == 3
    assert rows(pairs, "direct_trains", "days_observed", "distinct_services") == [(3, 2, 1)]


def test_stored_stops_are_read_without_a_shuffle(spark):
    stations = spark.createDataFrame(
        [(1, "A", "a", 1.0, 2.0, "stada", 1, "L", 5)],
        "station_eva BIGINT, station_name STRING, stada_name STRING, latitude DOUBLE, "
        "longitude DOUBLE, coordinate_source STRING, category INT, federal_state STRING, "
        "route_calls BIGINT")
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    data = observed(spark, stop("t", 1, "A", 2, 2, path_to=["B"]), stop("t", 2, "B", 5, 5),
                    stop("t", 3, "C", 1, 1))
    gold.build_gold(data, stations, "gold_test", buckets=4)
    stops = spark.table("gold_test.stop")
    assert "Exchange" not in plan_text(gold.trip_table(stops))
    assert "Exchange" not in plan_text(gold.consecutive_stops(stops))
    assert "Exchange" not in plan_text(gold.journeys(stops))
    assert spark.table("gold_test.station_pair").count() == 3
    assert spark.table("gold_test.segment").count() == 2
    assert one(spark.table("gold_test.daily_route")).trips_observed == 1
    # Building again replaces the tables.
    gold.build_gold(data, stations, "gold_test", buckets=4)
    assert spark.table("gold_test.stop").count() == 3


STATION = ("station_eva BIGINT, station_name STRING, stada_name STRING, latitude DOUBLE, "
           "longitude DOUBLE, coordinate_source STRING, category INT, federal_state STRING, "
           "route_calls BIGINT")


def test_build_refuses_what_later_steps_rest_on(spark, monkeypatch):
    data = observed(spark, stop("t", 1, "A", 2, 2, path_to=["B"]), stop("t", 2, "B", 5, 5),
                    stop("t", 3, "C", 1, 1))
    twice = spark.createDataFrame([(i, "A", "a", 1.0, 2.0, "x", 1, "L", 5) for i in (1, 2)],
                                  STATION)
    with pytest.raises(checks.DataQualityError, match="unique station names"):
        gold.build_gold(data, twice, "gold_names", buckets=2)
    assert not spark.catalog.tableExists("gold_names.stop")
    monkeypatch.setattr(checks.check_trip_length, "__defaults__", (2,))
    with pytest.raises(checks.DataQualityError, match="trip length"):
        gold.build_gold(data, twice.limit(1), "gold_long", buckets=2)
    assert not spark.catalog.tableExists("gold_long.station_pair")


def test_build_writes_all_tables_and_one_file_per_bucket(spark):
    points = [[float(i), 0.0] for i in range(130)]
    tracks = spark.createDataFrame([("A", "B", 9.0, points)], S.SEGMENT_GEOMETRY)
    stations = spark.createDataFrame([(1, "A", "a", 1.0, 2.0, "x", 1, "L", 5)], STATION)
    rows_ = [stop(f"t{i}", k, name, 1, 2) for i in range(40) for k, name in enumerate("ABC", 1)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        gold.build_gold(observed(spark, *rows_), stations, "gold_all", buckets=5, tracks=tracks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    found = {t.name: spark.table(f"gold_all.{t.name}").count()
             for t in spark.catalog.listTables("gold_all")}
    assert found == {"stop": 120, "trip": 40, "daily_route": 1, "station": 1, "segment": 2,
                     "station_pair": 3, "segment_geometry": 1, "segment_point": 65}
    assert len(spark.table("gold_all.stop").inputFiles()) == 5


def test_build_of_some_days_reads_only_their_folders(spark, tmp_path):
    data = observed(spark, stop("t", 1, "A", 2, 2)).withColumn(
        "observed_date", F.explode(F.expr("sequence(date'2026-05-01', date'2026-05-09')")))
    data.write.partitionBy("observed_date").parquet(str(tmp_path / "silver"))
    some = gold.in_days(spark.read.parquet(str(tmp_path / "silver")), "2026-05-03", "2026-05-04")
    assert some.count() == 2
    filters = next(x for x in plan_text(some).split("\n") if "PartitionFilters" in x)
    assert "observed_date" in filters.split("PartitionFilters: [")[1].split("]")[0]


def test_presentation_order(spark):
    df = spark.createDataFrame(
        [("2026-05-01", 9, "A", "B"), ("2026-05-02", 1, "A", "B"), ("2026-05-02", 3, "B", "A"),
         ("2026-05-02", 3, "A", "C")],
        "service_date STRING, trips_observed INT, origin STRING, destination STRING")
    got = [tuple(r)[1:] for r in gold.in_presentation_order(df).collect()]
    assert got == [(3, "A", "C"), (3, "B", "A"), (1, "A", "B"), (9, "A", "B")]


def test_checks_pass_and_fail(spark):
    data = observed(spark, stop("t", 1, "A", 2, path_to=["B"]), stop("t", 2, "B", 5))
    table = gold.stop_table(data)
    stations = spark.createDataFrame([("A",), ("B",)], "station_name STRING")
    checks.enforce_gold(data, table, stations)
    with pytest.raises(checks.DataQualityError, match="grain"):
        checks.enforce(checks.check_grain(table.unionByName(table)))
    with pytest.raises(checks.DataQualityError, match="collapse"):
        checks.enforce_gold(data, table.filter("stop_index = 1"), stations)
    with pytest.raises(checks.DataQualityError, match="unique station names"):
        checks.enforce_gold(data, table, stations.unionByName(stations))
    broken = table.withColumn("changed_arrival_at", table.changed_arrival_at.substr(1, 0)
                              .try_cast("timestamp"))
    assert one(checks.check_null_preserved(broken)).failures == 2
    assert one(checks.check_collapse(data, table)).detail == \
        "Silver: 2 obs, 2 stops -> Gold: 2 rows"


def test_geometry(spark):
    points = [[float(i), float(i) / 2] for i in range(125)]
    tracks = spark.createDataFrame(
        [("A", "B", 12.5, points), ("B", "C", 3.0, []), ("X", "Y", 1.0, points)],
        "from_station STRING, to_station STRING, track_km DOUBLE, "
        "coordinates ARRAY<ARRAY<DOUBLE>>")
    segments = spark.createDataFrame(
        [("A", "B", 1, 4, 0.5, 0.0, 1, 2), ("A", "B", 2, 9, 0.5, 0.0, 1, 2),
         ("B", "C", 1, 3, 0.5, 0.0, 1, 2)],
        "from_station STRING, to_station STRING, hops INT, trips BIGINT, "
        "avg_delay_gained_minutes DOUBLE, median_delay_gained_minutes DOUBLE, "
        "trips_losing_time BIGINT, trips_recovering_time BIGINT")
    table = geometry.segment_geometry_table(tracks, segments)
    assert rows(table, "from_station", "geometry_points", "trips") == [("A", 125, 4), ("B", 0, 3)]
    exploded = geometry.geometry_points_table(table)
    assert exploded.count() == 63
    second = one(exploded.filter("point_index = 1"))
    assert (second.segment, second.longitude, second.latitude) == ("A -> B", 2.0, 1.0)
    summary = one(geometry.geometry_summary(table, exploded))
    assert (summary.segments_with_geometry, summary.map_points, summary.total_track_km) == \
        (2, 63, 16.0)


def test_unresolved_pairs(spark):
    segments = spark.createDataFrame(
        [("A", "B", 1, 1.0, 1.0), ("A", "B", 1, 1.0, 1.0), ("B", "C", 1, 1.0, None),
         ("C", "D", 2, 1.0, 1.0), ("D", "E", 1, 1.0, 1.0)],
        "from_station STRING, to_station STRING, hops INT, from_latitude DOUBLE, "
        "to_latitude DOUBLE").selectExpr("*", "from_latitude AS from_longitude",
                                         "to_latitude AS to_longitude")
    known = spark.createDataFrame([("D", "E")], "from_station STRING, to_station STRING")
    assert rows(geometry.unresolved_pairs(segments, known), "from_station", "to_station") == \
        [("A", "B")]
