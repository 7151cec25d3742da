"""Days as bits, the sweep over minutes, sketches of days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stoptide.operators.reconcile import reconcile_ids
from stoptide.plans import summaries, timetable
from tests.conftest import one, plan_text, rows

CALENDAR = "service_id STRING, start_date STRING, end_date STRING, " + ", ".join(
    f"{d} STRING" for d in timetable.WEEKDAYS)
EXCEPTIONS = "service_id STRING, date STRING, exception_type STRING, line LONG"


def services(spark, seed):
    rng = random.Random(seed)
    day = [(dt.date(2026, 2, 20) + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range(150)]
    calendar = [(f"s{i % 9}", *sorted(rng.sample(day, 2)), *rng.choices("01", k=7))
                for i in range(11)]                    # two services have two rows
    exceptions = [(f"s{rng.randint(0, 11)}", rng.choice(day), rng.choice("12"), i)
                  for i in range(120)] + [("s1", "no date", "1", 500), ("s1", day[70], None, 501)]
    return (spark.createDataFrame(calendar, CALENDAR), spark.createDataFrame(exceptions, EXCEPTIONS),
            day)


def test_days_of_a_range_equal_the_single_days(spark):
    calendar, exceptions, day = services(spark, 1)
    first, last = day[3], day[140]                     # three words
    bits = timetable.service_days(calendar, exceptions, first, last, order="line")
    assert bits.columns == ["service_id", "w0", "w1", "w2"]
    bits = bits.cache()
    found = rows(timetable.running_days(bits, first))
    for date in [first, day[66], day[67], day[70], day[131], last]:
        want = rows(timetable.active_services(calendar, exceptions, date, order="line"))
        assert [(s,) for s, d in found if d == date] == want
        assert rows(bits.filter(timetable.runs_on(first, date)).select("service_id")) == want
    assert min(d for _, d in found) >= first and max(d for _, d in found) <= last


def test_a_range_reads_each_table_once(spark, tmp_path):
    calendar, exceptions, day = services(spark, 2)
    calendar.write.parquet(f"{tmp_path}/c")
    exceptions.write.parquet(f"{tmp_path}/e")
    text = plan_text(timetable.service_days(spark.read.parquet(f"{tmp_path}/c"),
                                            spark.read.parquet(f"{tmp_path}/e"), day[0], day[99]))
    assert text.count("FileScan") == 2
    empty = timetable.service_days(calendar.limit(0), exceptions.limit(0), day[0], day[99])
    assert empty.count() == 0


def test_every_minute_equals_the_coverage_at_it(spark):
    rng = random.Random(4)

    def moment():
        return f"{rng.randint(0, 25):02d}:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}"

    spans = [(f"t{i}", *sorted((moment(), moment()))) for i in range(60)]
    spans += [("x1", "9:05:00", "9:40:00"), ("x2", "12:75:00", "13:00:00"), ("x3", None, None),
              ("x4", "10:00:00", "10:00:00"), ("x5", "18:00:00", "07:00:00"), ("x6", "", "11:00:00"),
              ("x7", "00:00:00", "23:59:00"), ("x8", "noon", "zzz")]
    frame = spark.createDataFrame(spans, "trip_id STRING, first_time STRING, last_time STRING")
    trips = frame.select("trip_id", F.lit("r").alias("route_id"), F.lit("s").alias("service_id")) \
        .unionByName(spark.createDataFrame([("x9", "r", "s")],
                                           "trip_id STRING, route_id STRING, service_id STRING"))
    routes = spark.createDataFrame([("r", "a")], "route_id STRING, agency_id STRING")
    active = spark.createDataFrame([("s",)], "service_id STRING")
    feed = spark.createDataFrame([(f"t{i}",) for i in range(0, 60, 3)] + [("x4",)], "trip_id STRING")
    given = (trips, routes, frame, active, feed)
    swept = {(r.minute, r.state): (r.covered, r.total) for r in
             timetable.coverage_by_minute(timetable.active_trips(*given)).collect()}
    assert len(swept) == 3 * 1440
    for minute in ["00:00", "00:01", "07:00", "09:05", "09:06", "09:59", "10:00", "10:01", "12:59",
                   "13:00", "18:00", "23:59"]:
        states = timetable.trip_coverage(*given, F.lit(f"{minute}:00")).groupBy("state").agg(
            F.count_if("covered").alias("covered"), F.count(F.lit(1)).alias("total"))
        want = {r.state: (r.covered, r.total) for r in states.collect()}
        for state in ("running", "not yet started", "already finished"):
            assert swept[minute, state] == want.get(state, (0, 0)), (minute, state)


def trips(spark, n, seed=3):
    rng = random.Random(seed)
    data = [(dt.date(2026, 5, 1 + i % 7), "A", rng.choice("BC"), i % 11 != 0,
             None if i % 5 == 0 else int(rng.gauss(20, 30))) for i in range(n)]
    data += [(dt.date(2026, 5, 2), None, None, True, None)]
    return spark.createDataFrame(data, "service_date DATE, origin STRING, destination STRING, "
                                       "is_long_distance BOOLEAN, "
                                       "arrival_delay_at_last_observed INT")


@pytest.mark.parametrize(("n", "k"), [(300, 400), (12_000, 64)])
def test_percentiles_of_a_range_from_its_days(spark, tmp_path, n, k):
    every = trips(spark, n)
    summaries.delay_sketches(every, k).write.partitionBy("service_date").parquet(f"{tmp_path}/s")
    days = spark.read.parquet(f"{tmp_path}/s").filter("service_date >= '2026-05-03'")
    found = summaries.delay_percentiles(days, summaries.ROUTE, {"p50": 0.5, "p90": 0.9})
    assert "arrival_delay" not in plan_text(found)
    exact = {}
    for r in every.filter("is_long_distance AND service_date >= '2026-05-03'").collect():
        if r.arrival_delay_at_last_observed is not None:
            exact.setdefault((r.origin, r.destination), []).append(r.arrival_delay_at_last_observed)
    got = {(r.origin, r.destination): r for r in found.collect()}
    assert set(got) == set(exact)
    for route, delays in exact.items():
        error = 0 if len(delays) <= k else summaries.rank_error(k)
        assert got[route].known == len(delays)
        for value, p in ((got[route].p50, 0.5), (got[route].p90, 0.9)):
            assert sum(x < value for x in delays) / len(delays) <= p + error
            assert sum(x <= value for x in delays) / len(delays) >= p - error


def test_a_day_without_delays_has_no_sketch(spark):
    made = summaries.delay_sketches(trips(spark, 0))
    assert (one(made).trips, one(made).delays) == (1, None)
    assert summaries.delay_percentiles(made, summaries.ROUTE, {"p50": 0.5}).count() == 0


@pytest.mark.parametrize(("n", "lg"), [(500, 12), (30_000, 9)])
def test_sets_of_days_are_compared_without_their_ids(spark, n, lg):
    ids = spark.range(n).select(F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("d"),
                                "id").filter("(d = 'a' AND id % 2 = 0) OR (d = 'b' AND id % 3 = 0)")
    ids = ids.unionByName(ids.filter("id < 50")).unionByName(spark.createDataFrame(
        [("a", None)], "d STRING, id LONG"))
    pairs = summaries.days_with_the_next(summaries.id_sketches(ids, F.col("d"), "id", lg))
    got = one(summaries.compare_sets(pairs))
    want = one(reconcile_ids(ids.filter("d = 'a'"), ids.filter("d = 'b'"), "id"))
    union = want.matched + want.only_left + want.only_right
    for name in ("matched", "only_left", "only_right"):
        off = abs(got[name] - want[name])
        assert off <= (0 if n <= 2 ** lg else 1.5 * summaries.set_error(lg) * union)
    assert (got.day, got.next_day) == ("a", "b")
    assert got.pct_of_left == pytest.approx(want.pct_of_left, abs=0 if n <= 2 ** lg else 10)
