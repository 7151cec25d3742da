"""What has to stay bounded, or be done once, as the tables grow."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stoptide import session
from stoptide.catalog import documents, stateful, streams, summaries
from stoptide.plans import gold, increment
from stoptide.sources import files, frames
from stoptide.streaming import keyed
from tests.conftest import plan_text, rows
from tests.test_gold import observed, stop

_DAY = dt.datetime(2024, 1, 5)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Ten orders of three lines, and three events on each of twenty-five days."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(o, _DAY) for o in range(10)], "o_orderkey LONG, o_orderdate TIMESTAMP") \
        .write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(
        [(o, o * 7 + n, o % 4, n, 12.0, "N", "O", _DAY + dt.timedelta(days=n))
         for o in range(10) for n in (1, 2, 3)],
        "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP") \
        .write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame(
        [(d * 3 + u, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), u, "view" if d % 2 else "click")
         for d in range(25) for u in range(3)],
        "event_id LONG, ts TIMESTAMP, user_id LONG, event_type STRING") \
        .write.parquet(f"{path}/events.parquet")
    return path


@pytest.fixture()
def scratch(monkeypatch):
    """The scratch folders of a query, by label."""
    made = {}

    def recorded(spark, label):
        made[label] = session.scratch_dir(spark, label)
        return made[label]

    for module in (documents, stateful, streams, summaries):
        monkeypatch.setattr(module, "scratch_dir", recorded)
    return made


def _data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_sketched_trips_are_made_once(spark, tables, scratch):
    plan = plan_text(summaries._percentile_sketches(spark, tables))
    assert "Window" not in plan and "lineitem" not in plan
    assert "trips" in scratch


def test_stops_dealt_out_once_for_their_buckets(spark, tables):
    stops = gold.stop_table(frames.observations(spark, tables), partitions=3)
    plan = plan_text(stops.repartition(3, *gold.TRIP))
    assert plan.count("Exchange hashpartitioning(trip_id") == 1


def test_trips_are_dealt_out_before_anything_is_derived(spark, tables):
    plan = plan_text(gold.stop_table(frames.observations(spark, tables)))
    assert plan.count("Exchange hashpartitioning(") == 2
    behind = plan[:plan.index("Exchange")]
    for derived in ("service_date", "is_long_distance", "train_brand"):
        assert derived in behind and derived not in plan.removeprefix(behind)


def test_trip_ids_come_back_behind_the_shuffles(spark):
    told = [("t", "t"), ("u", "else"), ("v", None)]
    found = gold.stop_table(observed(spark, *[
        (s[0], given, *s[2:]) for s, given in ((stop(t, 1, "A"), g) for t, g in told)]))
    assert rows(found, "trip_id") == [("else",), ("t",), ("v",)]


def test_delays_are_made_below_the_join(spark, tables):
    plan = plan_text(frames.observations(spark, tables).select("stop_id", "arrival_delay_minutes"))
    assert "l_quantity" not in plan[:plan.index("Join")].rpartition("Project")[2]
    assert "l_quantity" in plan[plan.index("Join"):]


def test_buckets_follow_the_session(spark, tables, monkeypatch):
    asked = []
    save = gold.save_stops
    monkeypatch.setattr(gold, "save_stops", lambda s, t, buckets: (
        asked.append(buckets), save(s, t, buckets)))
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert documents._gold_tables(spark, tables).agg({"trips": "sum"}).first()[0] == 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert asked == [5]


def test_polled_documents_are_made_once(spark, tables, scratch):
    report = documents._poll_job(spark, tables)
    assert "collect_list" not in plan_text(report)
    assert report.count() == 25


def test_micro_batches_have_files_for_every_core(spark, tables, monkeypatch):
    asked = []
    stream = files.landed_stream
    monkeypatch.setattr(files, "landed_stream", lambda s, p, max_files=None: (
        asked.append(max_files), stream(s, p, max_files))[1])
    found = streams._stream_bounded_batches(spark, tables)
    assert found.agg({"records": "sum"}).first()[0] == 30
    assert asked == [spark.sparkContext.defaultParallelism]


def test_landed_files_are_bounded(spark, tables):
    path = streams.land_lines(spark, tables, file_records=4)
    assert max(r["n"] for r in spark.read.text(path).selectExpr("_metadata.file_path AS f")
               .groupBy("f").agg({"f": "count"}).toDF("f", "n").collect()) <= 4


def test_evolving_deliveries_are_compressed(spark, tables, scratch):
    assert streams._silver_evolution(spark, tables).count() == 30
    names = _data_files(scratch["landing"])
    assert names and all(n.endswith(".gz") for n in names)


def test_payloads_of_faulted_lines_are_made_once(spark, tables):
    lines = streams.record_lines(spark, tables, faults=True)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "regexp_replace(value#" in plan
    assert lines.count() == 30


def test_polls_are_dealt_into_slots_once(spark, tables, scratch):
    changed = stateful._stream_change_state(spark, tables)
    # per key and day one row, of one kind on even and another on odd days: all have changed
    assert changed.count() == 75
    dealt = sorted(n for n in os.listdir(scratch["staged"]) if n.startswith("slot="))
    assert dealt == ["slot=0", "slot=1", "slot=2"]


def test_a_key_asks_for_its_state_once():
    asked = []

    class State:
        def get(self):
            asked.append("get")

        def exists(self):
            asked.append("exists")
            return False

        def update(self, value):
            asked.append("update")

    class Handle:
        def getValueState(self, *a):
            return State()

        def registerTimer(self, at):
            asked.append("timer")

    step = keyed.CycleComparison()
    step.init(Handle())
    found = list(step.handleInputRows(("k",), iter([
        {"cycle": 1, "digest": "a", "at": _DAY}, {"cycle": 0, "digest": "a", "at": _DAY}]), None))
    assert [r["cycle"] for r in found] == [0]
    assert asked == ["get", "update", "timer"]


def test_state_is_not_counted_by_drains(spark, tables, tmp_path, monkeypatch):
    started = []
    drained = streams.medallion.drain

    def recorded(stream, *a, **kw):
        started.append((stream, drained(stream, *a, **kw)))
        return started[-1][1]

    monkeypatch.setattr(streams.medallion, "drain", recorded)
    out = streams._stream_dedup(spark, tables)
    assert out.count() == out.distinct().count() == 30
    (stream, query), = started
    # both deliveries come from one read of the lines and reach the state
    assert stream._jdf.queryExecution().logical().toString().count("StreamingRelation") == 1
    assert sum(p.numInputRows for p in query.recentProgress) == 30
    assert {o.numRowsTotal for p in query.recentProgress for o in p.stateOperators} <= {-1, 0}
    assert spark.conf.get(session._COUNTED_STATE, None) is None


def test_a_session_may_count_state_itself(spark):
    spark.conf.set(session._COUNTED_STATE, "true")
    with session.uncounted_state(spark):
        assert spark.conf.get(session._COUNTED_STATE) == "true"
    spark.conf.unset(session._COUNTED_STATE)


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}


def _left_behind(spark, before):
    """Shuffle files that are new and stay; they are removed in the background."""
    for _ in range(40):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.25)
    return left


def test_shuffles_go_with_their_statement(spark):
    key, before = session._SPENT_SHUFFLES, _shuffle_files(spark)
    with session.spent_shuffles(spark):
        assert spark.conf.get(key) == "true"
        spark.range(50).groupBy(F.col("id") % 7).count().write.format("noop").mode("overwrite").save()
    assert spark.conf.get(key, None) is None and not _left_behind(spark, before)
    spark.conf.set(key, "false")
    with session.spent_shuffles(spark):
        assert spark.conf.get(key) == "false"
    spark.conf.unset(key)


def test_an_update_leaves_only_the_set_behind(spark, tables, tmp_path, monkeypatch):
    made = []

    def recorded(spark_, label):
        made.append(str(tmp_path / f"{label}-{len(made)}"))
        return made[-1]

    monkeypatch.setattr(increment, "scratch_dir", recorded)
    before, root = _shuffle_files(spark), str(tmp_path / "set")
    rows_ = frames.observations(spark, tables)
    increment.update(rows_.filter("stop_index <= 2"), root,
                     frames.stations(spark, _with_stations(spark, tables)), circular=False)
    increment.update(rows_.filter("stop_index > 2"), root, circular=False)
    assert len(made) == 3 and not [p for p in made if os.path.exists(p)]
    assert not _left_behind(spark, before)
    assert increment.table(spark, root, "stop").count() == 30


def test_stop_tables_are_built_without_leftovers(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(gold, "scratch_dir", lambda s, label: str(tmp_path / label))
    before = _shuffle_files(spark)
    gold.build_gold(frames.observations(spark, tables), frames.stations(
        spark, _with_stations(spark, tables)), "lean", buckets=2, circular=False)
    assert not _left_behind(spark, before) and not os.path.exists(tmp_path / "collapsed")
    assert spark.table("lean.stop").count() == 30


def _with_stations(spark, tables):
    if not os.path.exists(f"{tables}/supplier.parquet"):
        spark.createDataFrame([(s, f"n{s}", s) for s in range(4)],
                              "s_suppkey LONG, s_name STRING, s_nationkey INT") \
            .write.parquet(f"{tables}/supplier.parquet")
    return tables


def test_quarantine_takes_few_files_at_once(spark, tables, scratch, monkeypatch):
    asked = []
    landed, bronze = files.landed_stream, streams.medallion.bronze_stream
    monkeypatch.setattr(files, "landed_stream", lambda s, p, max_files=None: (
        asked.append(max_files), landed(s, p, max_files))[1])
    monkeypatch.setattr(streams.medallion, "bronze_stream", lambda s, p, max_files=None: (
        asked.append(max_files), bronze(s, p, max_files))[1])
    few = 2 * spark.sparkContext.defaultParallelism
    assert streams._silver_quarantine(spark, tables).agg({"records": "sum"}).first()[0] == 30
    assert asked == [few] * 2
    assert streams._silver_evolution(spark, tables).count() == 30
    assert asked == [few] * 8
    for table in ("bronze", "silver"):
        file = glob.glob(f"{scratch[table]}/**/*.parquet", recursive=True)[0]
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_state_is_dealt_out_to_the_cores(spark, tables, scratch):
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert stateful._stream_change_state(spark, tables).count() == 75
        assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    dealt = [n for n in os.listdir(f"{scratch['state']}/state/0") if n.isdigit()]
    assert len(dealt) == spark.sparkContext.defaultParallelism
