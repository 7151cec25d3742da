from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stoptide import functions as fn
from stoptide import session
from tests.conftest import one, rows


def texts(spark, *values, name="t"):
    return spark.createDataFrame([(v,) for v in values], f"{name} STRING")


@pytest.mark.parametrize("text, expected", [
    ("2601201359", "2026-01-20 12:59:00"),      # winter
    ("2607141431", "2026-07-14 12:31:00"),      # summer
    ("2603290230", "2026-03-29 01:30:00"),      # the hour that does not exist
    ("2610250230", "2026-10-25 00:30:00"),      # the hour that exists twice: first reading
    ("", None), ("soon", None), ("2613400000", None), (None, None),
])
def test_db_timestamp(spark, text, expected):
    got = one(texts(spark, text).select(
        fn.db_timestamp(F.col("t")).cast("string").alias("r"))).r
    assert got == expected


def test_times_need_a_utc_session(spark):
    session.require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            session.require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_timestamp(spark):
    got = texts(spark, "2026-03-14T14:05:00+01:00", "yesterday", None).select(
        fn.iso_timestamp(F.col("t")).cast("string").alias("r")).collect()
    assert [r.r for r in got] == ["2026-03-14 13:05:00", None, None]


def test_delay_is_cut_towards_zero_and_null_without_a_time(spark):
    df = spark.sql("""
        SELECT timestamp'2026-01-01 10:00:00' AS p, s AS seconds,
          timestamp_seconds(unix_timestamp(timestamp'2026-01-01 10:00:00') + s) AS c
        FROM VALUES (90), (-90), (59), (-59), (NULL) AS t(s)""")
    got = df.select("seconds", fn.delay_minutes(F.col("p"), F.col("c")).alias("d")).collect()
    assert {r.seconds: r.d for r in got} == {90: 1, -90: -1, 59: 0, -59: 0, None: None}


def test_service_date_is_utc_unless_asked_for_local(spark):
    df = spark.sql("SELECT timestamp'2026-09-09 22:30:00' AS d, CAST(NULL AS TIMESTAMP) AS a")
    row = one(df.select(
        fn.service_date(F.col("d"), F.col("a")).alias("utc"),
        fn.service_date(F.col("a"), F.col("d")).alias("from_arrival"),
        fn.service_date(F.col("d"), F.col("a"), local_date=True).alias("local")))
    assert row.utc == row.from_arrival == dt.date(2026, 9, 9)
    assert row.local == dt.date(2026, 9, 10)


@pytest.mark.parametrize("stop_id, expected", [
    ("5200-2603141205-4", ("5200", "2603141205", 4)),
    ("-31415-2602281759-12", ("-31415", "2602281759", 12)),
    ("1-2-x", (None, None, None)), ("no dash", (None, None, None)), ("", (None, None, None)),
    (None, (None, None, None)),
])
def test_split_stop_id(spark, stop_id, expected):
    assert tuple(one(texts(spark, stop_id).select(*fn.split_stop_id(F.col("t"))))) == expected


def test_cancel_flag_is_never_null(spark):
    df = spark.createDataFrame(
        [(None, None), ("c", None), (None, "c"), ("a", "a"), ("c", "c")], "a STRING, d STRING")
    got = [r[0] for r in df.select(fn.cancel_flag(F.col("a"), F.col("d"))).collect()]
    assert got == [False, True, True, False, True]


@pytest.mark.parametrize("changed, planned, expected", [
    ("", "A|B", ["A", "B"]), (None, "A||B| ", ["A", "B"]), ("C", "A|B", ["C"]),
    ("", "", None), (None, None, None),
])
def test_path_array(spark, changed, planned, expected):
    df = spark.createDataFrame([(changed, planned)], "c STRING, p STRING")
    assert one(df.select(fn.path_array(F.col("c"), F.col("p")).alias("r"))).r == expected


def test_route_of_one_name_has_no_ends(spark):
    df = spark.createDataFrame(
        [(None, "M", None), (["A"], "M", ["Z"]), ([" "], "M", None), (["A"], "", ["Z"])],
        "f ARRAY<STRING>, s STRING, t ARRAY<STRING>")
    route = fn.route_build(F.col("f"), F.col("s"), F.col("t"))
    got = df.select(route.alias("r")).select(
        "r", fn.route_origin(F.col("r")), fn.route_destination(F.col("r")),
        fn.usable_length(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [
        (["M"], None, None, 0), (["A", "M", "Z"], "A", "Z", 3), (["M"], None, None, 0),
        (["A", "Z"], "A", "Z", 2)]


def test_long_distance_flag_is_null_for_an_unknown_category(spark):
    got = texts(spark, "ICE", "FLX", "RE", None).select(fn.is_long_distance(F.col("t")))
    assert [r[0] for r in got.collect()] == [True, True, False, None]


def test_scope_keeps_what_is_not_flagged(spark):
    got = rows(texts(spark, "F", "N", "S", "D", None).filter(fn.in_scope(F.col("t"))))
    assert got == [("F",), (None,)]


def test_digest_tells_null_from_empty_and_position(spark):
    df = spark.createDataFrame(
        [(None, "a"), ("a", None), ("", "a"), ("a", ""), ("a", "a")], "x STRING, y STRING")
    digests = [r[0] for r in df.select(fn.content_digest("x", "y")).collect()]
    assert len(set(digests)) == 5
    again = [r[0] for r in df.select(fn.content_digest("x", "y")).collect()]
    assert digests == again


def test_a_new_cancellation_changes_the_digest(spark):
    df = spark.createDataFrame([(None,), ("c",)], "arrival_status STRING")
    for name in fn.identity.CHANGE_FIELDS:
        if name != "arrival_status":
            kind = "array<array<string>>" if name == "messages" else "string"
            df = df.withColumn(name, F.lit(None).cast(kind))
    assert len({r[0] for r in df.select(fn.content_digest()).collect()}) == 2


def test_percent(spark):
    df = spark.createDataFrame([(1, 4), (3, 0), (0, 8)], "n BIGINT, d BIGINT")
    got = [r[0] for r in df.select(fn.percent(F.col("n"), F.col("d"))).collect()]
    assert got == ["25.00%", "n/a", "0.00%"]


@pytest.mark.parametrize("points, kept", [(1, 1), (59, 59), (60, 60), (119, 119), (120, 60),
                                          (125, 63), (0, 0)])
def test_downsample(spark, points, kept):
    df = spark.range(1).select(
        F.transform(F.sequence(F.lit(1), F.lit(max(points, 1))), lambda i: F.array(i, i))
        .alias("p"))
    if points == 0:
        df = df.select(F.slice("p", 1, 0).alias("p"))
    assert one(df.select(F.size(fn.downsample(F.col("p"))).alias("n"))).n == kept


def test_platform_change(spark):
    df = spark.createDataFrame(
        [("7", None), ("7", "7"), ("7", "9"), (None, "9"), (None, None), ("7", "")],
        "p STRING, c STRING")
    got = [r[0] for r in df.select(fn.platform_change(F.col("p"), F.col("c"))).collect()]
    assert got == ["7", "7", "7->9", "->9", "", "7"]


def test_percentiles_are_elements_and_exact_in_large_groups(spark):
    df = spark.range(300_000).selectExpr("CAST(pmod(hash(id), 211) - 60 AS INT) AS v") \
        .unionByName(spark.createDataFrame([(None,)], "v INT"))
    ordered = sorted(r.v for r in df.filter("v IS NOT NULL").collect())
    want = [ordered[-(-int(p * 100) * len(ordered) // 100) - 1] for p in (0.5, 0.9, 0.95)]
    assert one(df.agg(fn.percentile_array("v", [0.5, 0.9, 0.95]).alias("p"))).p == want
    near = one(df.agg(fn.percentile_array("v", [0.5], approximate=True).alias("p"))).p
    assert abs(near[0] - want[0]) <= 1
    assert one(df.limit(0).agg(fn.percentile_array("v", [0.5]).alias("p"))).p == [None]
