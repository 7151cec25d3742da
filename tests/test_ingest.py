from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stoptide.operators.latest import latest_plan
from stoptide.plans import ingest
from stoptide.sources.documents import (
    change_stops,
    is_timetable,
    plan_stops,
    split_failed,
    stored_documents,
)
from tests.conftest import (
    CHANGE_XML,
    EAST,
    LOST,
    NIGHT,
    NO_TRAIN,
    PLAN_XML,
    documents,
    one,
    poll,
    rows,
)


@pytest.fixture(scope="module")
def plan(spark):
    return plan_stops(documents(spark, PLAN_XML))


def by_id(df):
    return {r.stop_id: r for r in df.collect()}


def test_plan_stops(plan):
    stops = by_id(plan)
    assert len(stops) == 5
    east, night, none = stops[EAST], stops[NIGHT], stops[NO_TRAIN]
    assert east.planned_path_from.split("|") == ["Hamburg-Altona", "Hannover Hbf", "Göttingen"]
    assert (east.planned_path_to, east.planned_departure, east.planned_departure_platform) == \
        (None, None, None)
    assert (east.train_category, east.train_number, east.train_operator, east.train_filter,
            east.planned_arrival_platform) == ("EC", "115", "80", "F", "7")
    # the order of the elements does not matter
    assert (night.planned_arrival, night.planned_departure) == ("2607040347", "2607040351")
    assert night.planned_arrival_platform is None and night.planned_path_from is None
    assert (none.train_category, none.train_filter, none.planned_arrival) == \
        (None, None, "2607040601")
    assert stops["20415-2607041030-1"].planned_departure_platform == "11 D-F"
    assert stops["5-2607042355-2"].planned_departure is None


def test_change_stops(spark):
    stops = by_id(change_stops(documents(spark, CHANGE_XML)))
    assert len(stops) == 6 and None in stops
    night, lost, none = stops[NIGHT], stops[LOST], stops[NO_TRAIN]
    assert (night.changed_departure, night.changed_path_to) == \
        ("2607040404", "Fulda|Würzburg Hbf")
    assert night.changed_arrival is None and night.messages == []
    assert (lost.departure_status, lost.arrival_status, lost.brand) == ("a", None, "EN 40")
    assert lost.messages == [[None, "36", None]]
    assert none.messages == [["h", "43", "Störung"], ["f", "2", None]]
    assert stops["20415-2607041030-1"].messages == [["d", None, "Information"]]


@pytest.mark.parametrize("arrival, departure, want", [
    ('clt="2607040915" fb="A"', "", ("2607040915", "A")),
    ("", 'clt="2607040916" fb="D"', ("2607040916", "D")),
    ('clt="1" fb="A"', 'clt="2" fb="D"', ("1", "A")),
    ('clt="" fb=""', 'clt="3"', ("3", None)),
])
def test_time_of_cancellation_and_brand_of_either_leg(spark, arrival, departure, want):
    text = f"<timetable><s id='4-2607040000-2'><dp {departure}/><ar {arrival}/></s></timetable>"
    stop = one(change_stops(documents(spark, text)))
    assert (stop.cancelled_at, stop.brand or None) == want


def test_only_timetables_are_documents(spark):
    sound = [PLAN_XML, CHANGE_XML, " <timetable/>", "<?xml version='1.0'?>\n<timetable />"]
    faulty = ["<p>502 bad gateway</p>", "", None, "timetable", "<timetablex/>",
              "{}", "<html><timetable/></html>"]
    docs = documents(spark, *sound, *faulty)
    good, bad = split_failed(docs)
    assert (good.count(), bad.count()) == (len(sound), len(faulty))
    assert docs.filter(is_timetable(F.col("document"))).count() == len(sound)
    assert change_stops(bad).count() == 0


@pytest.mark.parametrize("cut", [20, 200, 500, len(CHANGE_XML) - 3])
def test_a_document_that_breaks_off_is_a_failure(spark, cut):
    docs = documents(spark, CHANGE_XML[:cut], CHANGE_XML).withColumn("cycle", F.lit(7))
    outcome = one(ingest.poll_outcomes(docs, "cycle"))
    assert (outcome.stations_polled, outcome.stations_failed) == (1, 1)
    assert change_stops(docs).count() == 6


def test_texts_keep_their_blanks_and_zeros(spark):
    text = "<timetable><s id='7-2607040000-1'><dp cp=' 08 ' cpth='|A || B'/></s></timetable>"
    stop = one(change_stops(documents(spark, text)))
    assert (stop.changed_departure_platform, stop.changed_path_to) == (" 08 ", "|A || B")


def test_observations_join_the_plan(spark, plan):
    seen = by_id(ingest.observations(poll(spark, CHANGE_XML), plan))
    # the suburban train is out of scope, the stop without an id has no key
    assert set(seen) == {NIGHT, EAST, LOST, NO_TRAIN}
    night = seen[NIGHT]
    assert (night.trip_id, night.start_datetime, night.stop_index) == \
        ("-3390125517", "2607032040", 12)
    assert (night.train_number, night.planned_departure, night.changed_departure) == \
        ("470", "2607040351", "2607040404")
    assert (night.station_eva, night.observed_at) == (8003200, "2026-07-04T10:25:30+02:00")
    lost = seen[LOST]
    assert (lost.train_category, lost.planned_departure, lost.brand) == (None, None, "EN 40")
    assert seen[EAST].cancelled_at == "2607040915"


def test_scopes(spark, plan):
    changes = poll(spark, CHANGE_XML)
    every = ingest.observations(changes, plan, only_long_distance=False)
    assert every.count() == 5
    strict = ingest.strict_long_distance(every)
    assert rows(strict, "train_number") == [("115",), ("470",)]


@pytest.mark.parametrize("flag, kept", [("F", True), ("N", False), ("S", False), (None, True)])
def test_scope_follows_the_flag_of_the_plan(spark, flag, kept):
    attribute = f"f='{flag}'" if flag else ""
    one_stop = plan_stops(documents(spark, f"<timetable><s id='9-2607041200-4'><tl {attribute} "
                                           "c='WB' n='962'/></s></timetable>"))
    changes = poll(spark, "<timetable><s id='9-2607041200-4'><ar ct='2607041500'/></s>"
                          "</timetable>")
    assert ingest.observations(changes, one_stop).count() == int(kept)


def test_counters(spark, plan):
    counters = one(ingest.poll_counters(poll(spark, CHANGE_XML), plan, "station_eva"))
    # without a train: the unknown stop and the one whose plan names none
    assert (counters.changed_stops, counters.identified, counters.unidentified,
            counters.observations) == (6, 3, 2, 4)


def test_match_rate(spark, plan):
    row = one(ingest.match_rate(poll(spark, CHANGE_XML), plan))
    assert (row.matched, row.unmatched, row.total) == (4, 2, 6)


def _work(spark, fetched, now="2026-07-04T21:40:00Z"):
    stations = spark.createDataFrame([(1,)], "eva BIGINT")
    return ingest.plan_worklist(stations, F.lit(now).cast("timestamp"), fetched)


def test_worklist_cold_and_warm(spark):
    nothing = spark.createDataFrame([], "eva BIGINT, slot STRING")
    cold = _work(spark, nothing)
    assert cold.count() == 18
    warm = _work(spark, cold.select("eva", "slot"))
    # 21:40 UTC is 23:40 in Berlin; the next hour is another day
    assert rows(warm, "offset", "slot") == [(0, "26070423"), (1, "26070500")]


@pytest.mark.parametrize("now, slots", [
    # last Sunday of March, before and after two o'clock; last Sunday of October
    ("2026-03-29T00:30:00Z", ["26032901", "26032902"]),
    ("2026-03-29T01:30:00Z", ["26032903", "26032904"]),
    ("2026-10-25T00:30:00Z", ["26102502", "26102503"]),
    ("2026-10-25T01:30:00Z", ["26102502", "26102503"]),
])
def test_worklist_around_the_change_of_the_clock(spark, now, slots):
    every = _work(spark, spark.createDataFrame([], "eva BIGINT, slot STRING"), now)
    assert [s for _, s in rows(every.filter("offset IN (0, 1)"), "offset", "slot")] == slots


def test_old_plan_hours_are_forgotten(spark):
    fetched = spark.createDataFrame(
        [(1, "26070123"), (1, "26070200"), (2, "26070423"), (2, "25123123")],
        "eva BIGINT, slot STRING")
    now = F.lit("2026-07-03T22:30:00Z").cast("timestamp")       # half past midnight on the 4th
    assert rows(ingest.recent_slots(fetched, now), "slot") == [("26070200",), ("26070423",)]


def test_newest_plan_and_cutoff(spark):
    plan = spark.createDataFrame(
        [("31-2607021955-2", 5, "second"), ("31-2607021955-2", 3, "first"),
         ("32-2606302359-1", 9, "June"), ("-8-2607010000-1", 1, "edge"), ("bad id", 2, "none")],
        "stop_id STRING, fetched_at INT, v STRING")
    assert rows(latest_plan(plan, F.lit("260701")), "v") == [("edge",), ("second",)]


def _put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_stored_documents_are_whole_files(spark, tmp_path):
    _put(tmp_path, "a.xml", PLAN_XML)
    assert one(stored_documents(spark, str(tmp_path))).document == PLAN_XML
