from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stoptide import schemas as S
from stoptide.plans.silver import silver
from stoptide.sources import files, kafka, sinks
from stoptide.streaming import batches, medallion
from tests.conftest import one, rows


STOP = "-66021-2611300455-14"


def payload(stop_id=STOP, **over):
    """A stop of a night train that leaves later than planned; most fields are unknown."""
    given = {
        "stop_id": stop_id, "stop_index": 14, "trip_id": "-66021", "start_datetime": "2611300455",
        "station_eva": 8002041, "station_name": "Frankfurt (Main) Süd", "train_number": "40421",
        "train_category": "NJ", "planned_departure": "2611301858",
        "changed_departure": "2611301911", "planned_departure_platform": "9 A-C",
        "planned_path_from": "Aschaffenburg Hbf|Hanau Hbf", "departure_status": "a",
        "messages": [["q", "59", None], ["h", None, "Information"]],
        "observed_at": "2026-11-30T18:40:12+01:00",
    }
    return {f.name: None for f in S.PAYLOAD} | given | over


def line(offset, value=None, partition=0, **over):
    text = value if isinstance(value, str) else json.dumps(value or payload())
    return json.dumps({"value": text, "key": None, "timestamp": 1796060412000,
                       "offset": offset, "partition": partition, "topic": "calls"} | over)


def put(folder: Path, name: str, *lines: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


@pytest.fixture()
def paths(tmp_path):
    return {n: tmp_path / n for n in ("landing", "bronze", "silver", "cb", "cs")}


def run(spark, paths, **kw):
    medallion.write_bronze(files.landed_stream(spark, str(paths["landing"])),
                           str(paths["bronze"]), str(paths["cb"]))
    return medallion.write_silver(
        medallion.bronze_stream(spark, str(paths["bronze"])), str(paths["silver"]),
        str(paths["cs"]), **kw)


def test_landing_to_silver(spark, paths):
    put(paths["landing"], "first.jsonl.gz", line(1))
    run(spark, paths)
    row = one(spark.read.parquet(str(paths["silver"])))
    assert (row.kafka_partition, row.kafka_offset, row.train_number) == (0, 1, "40421")
    assert row._source_file.endswith("first.jsonl.gz") and row._bronze_ingested_at
    assert (row.arrival_delay_minutes, row.departure_delay_minutes) == (None, 13)
    assert row.is_cancelled is False
    assert row.path_from == ["Aschaffenburg Hbf", "Hanau Hbf"]
    assert row.messages == [["q", "59", None], ["h", None, "Information"]]
    assert not {"planned_arrival", "start_datetime", "changed_path_to"} & set(row.asDict())


def test_each_file_is_read_once_over_restarts(spark, paths):
    put(paths["landing"], "a.jsonl.gz", line(1))
    run(spark, paths)
    put(paths["landing"], "b.jsonl.gz",
        line(2, payload(observed_at="2026-11-30T19:40:12+01:00")))
    run(spark, paths)
    run(spark, paths)
    assert rows(spark.read.parquet(str(paths["bronze"])), "offset") == [(1,), (2,)]
    assert spark.read.parquet(str(paths["silver"])).count() == 2


def test_repeated_observations_are_dropped_within_and_across_runs(spark, paths):
    put(paths["landing"], "a.jsonl.gz", line(1), line(2))
    run(spark, paths)
    put(paths["landing"], "b.jsonl.gz", line(3))
    run(spark, paths)
    assert spark.read.parquet(str(paths["silver"])).count() == 1


def test_what_silver_leaves_out_is_in_quarantine(spark, paths):
    put(paths["landing"], "a.jsonl.gz", line(10), '{"topic": "calls", "part', '{"other": true}',
        line(13, "[1]"), line(14, payload(observed_at="soon")), line(15, payload(stop_id=None)),
        line(16, payload("9-2611300000-1")), line(None))
    aside = str(paths["silver"]) + "-aside"
    run(spark, paths, quarantine=aside)
    bronze = spark.read.schema(S.BRONZE).parquet(str(paths["bronze"]))
    kept = spark.read.parquet(str(paths["silver"]))
    left_out = spark.read.parquet(aside)
    assert rows(kept, "kafka_offset") == [(10,), (16,)]
    assert sorted((r.reason, r.offset) for r in left_out.collect() if r.offset) == [
        ("no observation time", 14), ("no stop id", 13), ("no stop id", 15)]
    assert sorted(r.reason for r in left_out.collect() if not r.offset) == [
        "not JSON", "not a record", "not a record"]
    assert bronze.count() == kept.count() + left_out.count()
    run(spark, paths, quarantine=aside)
    assert spark.read.parquet(aside).count() == 6
    assert [r[0] for r in left_out.filter("reason = 'not JSON'").select("_corrupt_record")
            .collect()] == ['{"topic": "calls", "part']


def test_late_rows_are_counted_over_all_batches(spark, paths):
    """More batches than the query keeps progress reports of."""
    put(paths["landing"], "a.jsonl.gz", line(0))
    run(spark, paths, watermark="1 day")
    for n in range(1, 13):
        put(paths["landing"], f"b{n:02d}.jsonl.gz", line(
            n, payload(f"{n}-2611010000-1", observed_at=f"2026-11-{n:02d}T12:00:00+01:00")))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        medallion.write_bronze(files.landed_stream(spark, str(paths["landing"]), max_files=1),
                               str(paths["bronze"]), str(paths["cb"]))
        query = medallion.write_silver(
            medallion.bronze_stream(spark, str(paths["bronze"]), max_files=1),
            str(paths["silver"]), str(paths["cs"]), watermark="1 day")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(query.recentProgress) <= 4
    assert medallion.late_rows(query) == 12


def test_bad_times_become_null_and_do_not_stop_the_stream(spark, paths):
    put(paths["landing"], "a.jsonl.gz",
        line(1, payload(planned_arrival="", changed_departure="26xx", cancelled_at="soon")))
    run(spark, paths)
    row = one(spark.read.parquet(str(paths["silver"])))
    assert (row.planned_arrival_at, row.changed_departure_at, row.cancelled_at,
            row.arrival_delay_minutes) == (None, None, None, None)


def test_late_rows_are_dropped_and_reported(spark, paths):
    put(paths["landing"], "a.jsonl.gz", line(1))
    run(spark, paths, watermark="1 day")
    put(paths["landing"], "b.jsonl.gz",
        line(2, payload("17-2611281000-1", observed_at="2026-11-28T18:00:00+01:00")),
        line(3, payload("18-2611300900-1", observed_at="2026-11-30T11:00:00+01:00")))
    query = run(spark, paths, watermark="1 day")
    assert rows(spark.read.parquet(str(paths["silver"])), "kafka_offset") == [(1,), (3,)]
    assert medallion.late_rows(query) == 1


def test_the_default_watermark_outlasts_a_full_replay(spark, paths):
    put(paths["landing"], "a.jsonl.gz", line(1))
    run(spark, paths)
    put(paths["landing"], "b.jsonl.gz",
        line(2, payload("17-2611270900-1", observed_at="2026-11-27T19:00:00+01:00")))
    assert medallion.late_rows(run(spark, paths)) == 0
    assert spark.read.parquet(str(paths["silver"])).count() == 2


def test_silver_by_day(spark, paths):
    put(paths["landing"], "a.jsonl.gz", line(1),
        line(2, payload(observed_at="2026-12-01T12:00:00+01:00")))
    run(spark, paths, by_date=True)
    assert sorted(p.name for p in paths["silver"].glob("observed_date=*")) == [
        "observed_date=2026-11-30", "observed_date=2026-12-01"]


def test_bounded_batches(spark, paths):
    for i in range(3):
        put(paths["landing"], f"{i}.jsonl.gz", line(i))
    query = medallion.write_bronze(
        files.landed_stream(spark, str(paths["landing"]), max_files=1),
        str(paths["bronze"]), str(paths["cb"]))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert spark.read.parquet(str(paths["bronze"])).count() == 3


RECORDS = "topic STRING, partition INT, offset BIGINT, timestamp BIGINT, key STRING, value STRING"


def records(spark, *pairs):
    return spark.createDataFrame(
        [("t", p, o, 1790000000000, None, f'{{"o":{o}}}') for p, o in pairs], RECORDS)


@pytest.mark.parametrize("topic, partition, first, last, name", [
    ("calls", 11, 0, 0, "calls-p11-000000000000-000000000000"),
    ("c", 2, 999_999_999_999, 1_000_000_000_000, "c-p2-999999999999-1000000000000"),
])
def test_batch_names_come_from_offsets(spark, topic, partition, first, last, name):
    df = spark.range(1).select(sinks.batch_name(
        F.lit(topic), F.lit(partition), F.lit(first), F.lit(last)).alias("n"))
    assert one(df).n == name


def test_each_partition_has_its_batches_of_bounded_size(spark, tmp_path):
    df = records(spark, *[(0, o) for o in range(95, 125)], (1, 7))
    sinks.write_landing_batches(df, str(tmp_path / "l"), 10)
    names = sorted(p.name for p in (tmp_path / "l").iterdir() if p.is_dir())
    assert names == [
        "batch=t-p0-000000000095-000000000099", "batch=t-p0-000000000100-000000000109",
        "batch=t-p0-000000000110-000000000119", "batch=t-p0-000000000120-000000000124",
        "batch=t-p1-000000000007-000000000007"]
    landed = files.landed_records(spark, str(tmp_path / "l"))
    assert landed.count() == 31
    assert set(landed.columns) == {f.name for f in S.BRONZE}
    row = one(landed.filter("partition = 1"))
    assert (row.key, row.value, row.offset) == (None, '{"o":7}', 7)
    assert all(p.name.endswith(".gz") for p in (tmp_path / "l").rglob("part-*"))


def test_a_replay_of_a_landed_batch_changes_nothing(spark, tmp_path):
    step = batches.land(str(tmp_path / "l"), 10)
    step(records(spark, (0, 1), (0, 2)), 0)
    before = sorted(p.name for p in (tmp_path / "l").rglob("part-*"))
    step(records(spark, (0, 1), (0, 2)), 0)
    assert sorted(p.name for p in (tmp_path / "l").rglob("part-*")) == before


def test_a_batch_that_did_not_finish_is_replaced(spark, tmp_path):
    target = tmp_path / "l" / "drain=0"
    sinks.write_landing_batches(records(spark, (0, 1)), str(target), 10)
    (target / "_SUCCESS").unlink()
    batches.land(str(tmp_path / "l"), 10)(records(spark, (0, 1)), 0)
    assert files.landed_records(spark, str(tmp_path / "l")).count() == 1


def test_a_failed_write_leaves_the_records_for_the_next_run(spark, tmp_path):
    source = str(tmp_path / "in")
    records(spark, (0, 1), (0, 2)).write.parquet(source)

    def attempt(step):
        stream = spark.readStream.schema(RECORDS).parquet(source)
        query = stream.writeStream.foreachBatch(step).trigger(availableNow=True) \
            .option("checkpointLocation", str(tmp_path / "c")).start()
        query.awaitTermination()

    def failing(_df, _number):
        raise RuntimeError("upload failed")

    with pytest.raises(Exception, match="upload failed"):
        attempt(failing)
    attempt(batches.land(str(tmp_path / "l"), 10))
    assert files.landed_records(spark, str(tmp_path / "l")).count() == 2


def test_daily_json_lines(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", None, "2026-05-10 23:59:00"), ("b", "x", "2026-05-11 00:00:00")],
        "stop_id STRING, brand STRING, observed_at STRING").withColumn(
        "observed_at", F.col("observed_at").cast("timestamp"))
    out = tmp_path / "out"
    sinks.append_jsonl_daily(df, str(out))
    sinks.append_jsonl_daily(df.filter("stop_id = 'a'"), str(out))
    days = {p.name: sum(len(f.read_text().splitlines()) for f in p.glob("part-*"))
            for p in out.iterdir() if p.is_dir()}
    assert days == {"dt=2026-05-10": 2, "dt=2026-05-11": 1}
    first = next((out / "dt=2026-05-10").glob("part-*")).read_text().splitlines()[0]
    assert json.loads(first)["brand"] is None
    sinks.append_jsonl_daily(df.limit(0), str(tmp_path / "none"))
    assert not list((tmp_path / "none").rglob("part-*"))


def test_messages_for_the_broker(spark):
    df = spark.createDataFrame([payload()], S.PAYLOAD)
    row = one(kafka.as_messages(df))
    assert bytes(row.key) == STOP.encode()
    assert json.loads(bytes(row.value)) == payload()
    assert [(h.key, bytes(h.value)) for h in row.headers] == [("schema_version", b"1")]


def test_messages_of_the_connector_become_records(spark):
    df = spark.sql("""SELECT binary('k') AS key, binary('v') AS value, 't' AS topic,
        3 AS partition, 9L AS offset, timestamp_millis(1790000000123) AS timestamp""")
    assert tuple(one(kafka.as_records(df))) == ("t", 3, 9, 1790000000123, "k", "v")
    assert kafka.as_records(df).columns == S.RECORD_COLUMNS


def test_silver_reads_each_payload_once(spark):
    from tests.conftest import plan_text

    plan = plan_text(silver(records(spark, (0, 1))))
    assert plan.count("from_json(") == 1
