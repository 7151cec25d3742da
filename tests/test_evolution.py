"""Tables whose columns grow; emitted lines of repeated runs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stoptide import schemas as S
from stoptide.plans import poll
from stoptide.sources import evolution, files, versions
from stoptide.streaming import medallion
from tests.conftest import rows

WIDER = T.StructType([*S.PAYLOAD.fields, T.StructField("occupancy", T.IntegerType()),
                      T.StructField("vehicle", T.StructType([
                          T.StructField("coaches", T.IntegerType())]))])


def ddl(text):
    return T.StructType.fromDDL(text)


def test_columns_are_added_in_order(spark):
    both = evolution.merged(ddl("a INT, b STRING"), ddl("b STRING, c LONG, A INT"))
    assert both.simpleString() == "struct<a:int,b:string,c:bigint>"
    nested = evolution.merged(ddl("m ARRAY<STRUCT<x: INT>>, k MAP<STRING, STRUCT<p: INT>>"),
                              ddl("m ARRAY<STRUCT<y: INT>>, k MAP<STRING, STRUCT<q: INT>>"))
    assert nested.simpleString() == \
        "struct<m:array<struct<x:int,y:int>>,k:map<string,struct<p:int,q:int>>>"


@pytest.mark.parametrize("new", ["a LONG", "a STRING", "A STRING", "n STRUCT<x: STRING>",
                                 "l ARRAY<LONG>", "n INT", "z INT, Z INT"])
def test_other_types_are_refused(spark, new):
    with pytest.raises(evolution.SchemaConflict):
        evolution.merged(ddl("a INT, n STRUCT<x: INT>, l ARRAY<INT>"), ddl(new))


def test_declaring_twice_writes_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert evolution.schema(spark, path) is None
    with pytest.raises(ValueError, match="declared"):
        evolution.read(spark, path)
    evolution.declare(spark, path, ddl("a INT"))
    evolution.declare(spark, path, ddl("a INT"))
    assert evolution.read(spark, path).collect() == []
    evolution.declare(spark, path, ddl("b STRING"))
    assert evolution.schema(spark, path).names == ["a", "b"]
    assert len([f for f in (tmp_path / "t" / "_schema").iterdir() if f.suffix == ".json"]) == 2


def test_a_table_from_before_the_log(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).selectExpr("id", "'x' AS old").write.parquet(path)
    spark.range(1).selectExpr("id").write.mode("append").parquet(path)
    evolution.declare(spark, path, ddl("id LONG, new DOUBLE"))
    spark.range(5, 6).selectExpr("id", "1.5D AS new").write.mode("append").parquet(path)
    assert rows(evolution.read(spark, path)) == sorted(
        [(0, "x", None), (1, "x", None), (0, None, None), (5, None, 1.5)], key=repr)
    with pytest.raises(evolution.SchemaConflict, match="old is string"):
        evolution.declare(spark, path, ddl("old INT"))


def land(spark, landing, number, stop, **fields):
    value = {"stop_id": stop, "observed_at": f"2026-05-0{number}T10:00:00+02:00", **fields}
    record = {"topic": "t", "partition": 0, "offset": number, "timestamp": 1, "key": stop,
              "value": json.dumps(value)}
    spark.createDataFrame([(json.dumps(record),)], "value STRING").write.text(
        f"{landing}/delivery={number}")


def test_silver_with_a_new_column_one_without_and_a_restart(spark, tmp_path):
    landing, bronze, silver, state = (str(tmp_path / n) for n in ("l", "b", "s", "c"))

    def run(payload, **kw):
        medallion.write_bronze(files.landed_stream(spark, landing), bronze, f"{state}/bronze")
        return medallion.write_silver(medallion.bronze_stream(spark, bronze), silver,
                                      f"{state}/silver", payload=payload, by_date=True, **kw)

    land(spark, landing, 1, "a-2605010600-1", brand="X", occupancy=70)
    run(S.PAYLOAD)
    land(spark, landing, 2, "b-2605010600-1", occupancy=30, vehicle={"coaches": 9})
    run(WIDER, day_slices=2)
    land(spark, landing, 3, "c-2605010600-1", occupancy=99)
    run(S.PAYLOAD)
    found = medallion.silver_table(spark, silver)
    assert rows(found, "stop_id", "brand", "occupancy", "vehicle.coaches",
                F.col("observed_date").cast("string")) == [
        ("a-2605010600-1", "X", None, None, "2026-05-01"),
        ("b-2605010600-1", None, 30, 9, "2026-05-02"),
        ("c-2605010600-1", None, None, None, "2026-05-03")]
    # a column of another type stops the run before it writes
    other = T.StructType([*S.PAYLOAD.fields, T.StructField("occupancy", T.StringType())])
    land(spark, landing, 4, "d-2605010600-1", occupancy="full")
    with pytest.raises(evolution.SchemaConflict, match="occupancy"):
        run(other)
    assert medallion.silver_table(spark, silver).count() == 3
    run(WIDER)
    assert medallion.silver_table(spark, silver).count() == 4
    # a reader downstream sees all columns, and each row once
    out, kept = str(tmp_path / "out"), str(tmp_path / "kept")
    for _ in range(2):
        medallion.drain(medallion.silver_stream(spark, silver).select("stop_id", "occupancy"),
                        out, kept)
    assert spark.read.parquet(out).count() == 4


def documents(spark, *cycles):
    """One station's documents: (cycle, platform of stop 1, platform of stop 2)."""
    made = []
    for cycle, *platforms in cycles:
        stops = "".join(f'<s id="{i}-2605010600-1"><ar cp="{p}"/></s>'
                        for i, p in enumerate(platforms) if p)
        made.append((f"<timetable>{stops}</timetable>", 1, "X",
                     f"2026-05-0{1 + cycle // 2}T10:00:00+00:00", cycle))
    return spark.createDataFrame(made, "document STRING, station_eva LONG, station_name STRING, "
                                       "observed_at STRING, cycle INT")


def plan(spark):
    return spark.createDataFrame([], S.T.StructType(
        [T.StructField("stop_id", T.StringType()),
         *[T.StructField(c, T.StringType()) for c in S.PLAN_FIELDS]]))


def lines(spark, root):
    return rows(spark.read.schema("stop_id STRING, changed_arrival_platform STRING, dt STRING")
                .json(f"{root}/lines"), "stop_id", "changed_arrival_platform", "dt")


def test_a_run_that_breaks_off_is_repeated_without_double_lines(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "poll")
    assert poll.advance(documents(spark, (0, "1", "2"), (1, "1", "3")), plan(spark), root) == 1
    first = lines(spark, root)
    assert [x[1] for x in first] == ["1", "2", "3"]
    more = documents(spark, (0, "1", "2"), (1, "1", "3"), (2, "1", "4"), (3, "5", "4"))
    with monkeypatch.context() as m:                 # lines are written, the state is not
        m.setattr(versions.Draft, "publish", lambda self: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            poll.advance(more, plan(spark), root)
    assert versions.numbers(spark, root) == [1]
    assert poll.advance(more, plan(spark), root) == 2
    want = sorted([*first, ("1-2605010600-1", "4", "2026-05-02"),
                   ("0-2605010600-1", "5", "2026-05-02")], key=repr)
    assert lines(spark, root) == want
    assert poll.advance(more, plan(spark), root) is None
    assert lines(spark, root) == want
    report = versions.read(spark, root, "report")
    assert rows(report, "cycle", "seen", "written", "suppressed") == [
        (0, 2, 2, 0), (1, 2, 1, 1), (2, 2, 1, 1), (3, 2, 1, 1)]


def test_an_empty_cycle_clears_the_state(spark, tmp_path):
    root = str(tmp_path / "poll")
    poll.advance(documents(spark, (0, "1", None)), plan(spark), root)
    poll.advance(documents(spark, (1, None, None)), plan(spark), root)
    poll.advance(documents(spark, (2, "1", None)), plan(spark), root)
    assert len(lines(spark, root)) == 2
    assert versions.numbers(spark, root) == [1, 2, 3]
