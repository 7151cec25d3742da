"""Streams whose state the engine keeps, against the batch operators."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stoptide.operators.changes import changed_since_previous, cycle_counters
from stoptide.sources import versions
from stoptide.streaming import counters, keyed, plans
from tests.conftest import rows

POLL = "key LONG, cycle INT, position LONG, digest STRING"
COLUMNS = ["key", "cycle", "position", "digest"]
T0 = dt.datetime(2026, 5, 1, 12, 0)


def polls(seed, cycles=9, keys=12):
    rng = random.Random(seed)
    out = []
    for cycle in range(cycles):
        for key in range(keys):
            for _ in range(0 if cycle == 4 else rng.choice([0, 1, 1, 2])):   # cycle 4 is empty
                out.append((key, cycle, len(out), rng.choice("ab")))
    return out


def test_keyed_changes_equal_the_batch_over_cuts_and_restarts(spark, tmp_path):
    data = polls(1)
    want = changed_since_previous(spark.createDataFrame(data, POLL))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    waiting = []
    # rows of odd position come a cycle late; the second cut goes through a cycle
    late = {0: lambda c: c <= 3, 1: lambda c: c > 3}
    for run in range(2):
        part = [r for r in data if late[run](r[1] + r[2] % 2)]
        if run:
            part.append((None, 20, 0, None))
        spark.createDataFrame(part, POLL).coalesce(1).write.parquet(f"{source}/run={run}")
        stream = spark.readStream.schema(f"{POLL}, run INT").parquet(source).drop("run")
        query = keyed.filter_changes(stream, out, state)
        waiting.append(sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]))
    found = spark.read.parquet(out).withColumn("key", F.col("key").cast("long"))
    assert rows(found, *COLUMNS) == rows(want, *COLUMNS)
    # what waits is what is open; once all cycles are closed, keys leave nothing behind
    assert waiting[0] < 3 * 3 * 12 and waiting[1] <= 1


def test_rows_of_closed_cycles_are_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    deliveries = [[(1, 0, 0, "a"), (1, 1, 1, "a"), (None, 6, 2, None)],
                  [(1, 1, 3, "b"), (2, 6, 4, "x"), (None, 12, 5, None)]]
    dropped = 0
    for n, part in enumerate(deliveries):
        spark.createDataFrame(part, POLL).coalesce(1).write.parquet(f"{source}/run={n}")
        stream = spark.readStream.schema(f"{POLL}, run INT").parquet(source).drop("run")
        query = keyed.filter_changes(stream, out, state, lateness=1)
        dropped += sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress
                       for o in p["stateOperators"])
    assert rows(spark.read.parquet(out), "key", "cycle") == [("1", 0), ("2", 6)]
    assert dropped >= 1


def test_counters_equal_the_batch_after_three_runs(spark, tmp_path):
    data = spark.createDataFrame(polls(3), POLL)
    emitted = changed_since_previous(data)
    want = cycle_counters(data, emitted)
    flagged = data.join(emitted.select("position", F.lit(True).alias("written")), "position",
                        "left").select(
        "cycle", "position", F.coalesce("written", F.lit(False)).alias("written"),
        F.timestamp_seconds(F.col("cycle") * 3600 + F.col("position") % 60).alias("observed_at"))
    source, root, state = (str(tmp_path / n) for n in ("in", "set", "state"))
    for run in range(3):
        flagged.filter(F.col("position") % 3 == run).write.parquet(f"{source}/run={run}")
        stream = spark.readStream.schema(f"{flagged.schema.toDDL()}, run INT").parquet(source)
        counters.count_cycles(stream, root, state, watermark="2 days")
        reader = counters.cycle_table(spark, root)
    columns = ["cycle", "seen", "written", "suppressed"]
    assert rows(reader, *columns) == rows(want, *columns)
    # a batch that is run again, and one without rows, change nothing
    again = versions.read(spark, root, counters.TABLE).filter("cycle < 3")
    step = counters.upsert(root)
    step(again, 7)
    step(again.limit(0), 8)
    assert rows(counters.cycle_table(spark, root), *columns) == rows(want, *columns)
    with pytest.raises(ValueError, match="counted"):
        counters.cycle_table(spark, str(tmp_path / "none"))


def test_plans_before_after_and_without_their_change(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    changes = [("a", T0, "X"), ("b", T0, "X"), ("c", T0, None), ("d", T0, "X"), ("a", T0, "X"),
               ("f", T0, "X")]
    plan = [("a", T0 - 3 * hour, "ICE"), ("a", T0 - hour, "IC"), ("b", T0 + 2 * hour, "RE"),
            ("d", T0 - 13 * hour, "too early"), ("d", T0 + 7 * hour, "too late"),
            ("f", T0 - 12 * hour, "first"), ("f", T0 + 6 * hour, "last"),
            ("e", T0, "no change")]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    end = T0 + dt.timedelta(days=3)
    later = [("end", end, None)]
    seen = []
    for run, (left, right) in enumerate(((changes, plan[:2]), ([], plan[2:]),
                                         (later, [("end", end, "x")]))):
        spark.createDataFrame(left, "stop_id STRING, observed_at TIMESTAMP, station STRING") \
            .write.parquet(f"{tmp_path}/changes/run={run}")
        spark.createDataFrame(right, "stop_id STRING, fetched_at TIMESTAMP, train_category STRING") \
            .write.parquet(f"{tmp_path}/plan/run={run}")
        streams = [spark.readStream.schema(f"{ddl}, run INT").parquet(f"{tmp_path}/{n}")
                   .drop("run") for n, ddl in (
            ("changes", "stop_id STRING, observed_at TIMESTAMP, station STRING"),
            ("plan", "stop_id STRING, fetched_at TIMESTAMP, train_category STRING"))]
        plans.join_plans(*streams, out, state)
        seen.append(spark.read.schema("stop_id STRING, observed_at TIMESTAMP, station STRING, "
                                      "train_category STRING").parquet(out).count())
    # nothing is given out while a plan may still come; unmatched changes come out as well
    assert seen == [0, 0, 5]
    found = spark.read.parquet(out)
    assert rows(found, "stop_id", "station", "train_category") == sorted(
        [("a", "X", "IC"), ("b", "X", "RE"), ("c", None, None), ("d", "X", None),
         ("f", "X", "last")], key=repr)
    assert {r["observed_at"] for r in found.collect()} == {T0}
