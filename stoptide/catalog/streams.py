"""Streaming queries: each drains its source, stops, and reads back what it wrote.

The sources are the driver's tables themselves or files Spark wrote from them. Where the
order of arrival matters, two runs on one checkpoint each take what is there, so results do
not depend on how many files a run finds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import computed_once, content_digest
from ..operators.changes import number_cycles
from ..session import scratch_dir, spent_shuffles
from ..sources import files, frames
from ..streaming import batches, changes, medallion
from .expressions import SILVER_COLUMNS
from .joins import CHANGE_SQL
from .oracle import text, using
from .registry import _sql, query


def table_stream(spark, sf: str, name: str):
    """A driver table as a file stream: the folder it is, or the one file in its folder."""
    reader = spark.readStream.schema(frames.table(spark, sf, name).schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/{name}.parquet")
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    if status.isFile():
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf)
    return reader.parquet(path.toString())


def stop_stream(spark, sf: str):
    """The observation rows as a stream: order lines against the orders at rest."""
    orders = frames.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return frames.from_lines(table_stream(spark, sf, "lineitem"), orders)


# Records per landed file of the queries that take few files at once.
_FILE_RECORDS = 200_000


def files_at_once(spark, each: int) -> int:
    """Files of a micro-batch: `each` for every core. A gzip file is read by one core, so a fixed
    number would leave the others idle, however many there are."""
    return each * spark.sparkContext.defaultParallelism


def record_lines(spark, sf: str, faults: bool = False):
    """Records as JSON lines; with `faults`, some are cut off, of another shape or blank, and some
    payloads lack the stop id or have no readable time."""
    records = frames.records(frames.payloads(spark, sf))
    number = F.pmod(F.col("offset"), F.lit(53))
    if faults:
        # made once: each branch below would hold the code of a whole payload, too much to compile
        records = records.select(
            *[c for c in records.columns if c != "value"], computed_once(F.col("value"))
            .alias("value"))
        value = F.col("value")
        records = records.withColumn("value", F.when(
            number == 3, F.regexp_replace(value, '"stop_id":"[^"]*"', '"stop_id":null')).when(
            number == 4, F.regexp_replace(value, '"observed_at":"[^"]*"', '"observed_at":"noon"'))
            .otherwise(value))
    line = F.to_json(F.struct(*S.RECORD_COLUMNS), {"ignoreNullFields": "false"})
    if faults:
        line = (F.when(number == 0, F.concat(F.lit('{"topic": "'), F.col("key")))
                .when(number == 1, F.to_json(F.struct(F.col("key").alias("probe"))))
                .when(number == 2, F.lit("")).otherwise(line))
    return records.select(line.alias("value"))


def land_lines(spark, sf: str, faults: bool = False, file_records: int = 0) -> str:
    """`record_lines` as gzip files; `file_records` bounds a file."""
    path = scratch_dir(spark, "landing")
    with spent_shuffles(spark):
        record_lines(spark, sf, faults).write.option("compression", "gzip") \
            .option("maxRecordsPerFile", file_records).text(path)
    return path


@query("src_landing_stream",
       f"SELECT *, true AS from_landing, true AS stamped FROM ({_sql['silver_parse']})")
def _src_landing_stream(spark, sf):
    """Landing files -> Bronze -> Silver, as three streams that drain and stop.

    Few files per core and batch; the watermark covers the seven years that the rows span.
    """
    landing = land_lines(spark, sf, file_records=_FILE_RECORDS)
    few = files_at_once(spark, 2)
    bronze, silver, state = (scratch_dir(spark, n) for n in ("bronze", "silver", "state"))
    medallion.write_bronze(files.landed_stream(spark, landing, max_files=few), bronze,
                           f"{state}/bronze")
    medallion.write_silver(medallion.bronze_stream(spark, bronze, max_files=few), silver,
                           f"{state}/silver", watermark="4000 days")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(silver)
    return rows.select(
        *SILVER_COLUMNS, F.col("_source_file").contains(landing.rpartition("/")[2])
        .alias("from_landing"), F.col("_bronze_ingested_at").isNotNull().alias("stamped"))


@query("src_corrupt_capture", using("f", body="""
SELECT kind, count(*) AS lines FROM (SELECT CASE kafka_offset % 53 WHEN 0 THEN 'corrupt'
  WHEN 1 THEN 'other shape' WHEN 2 THEN 'blank' ELSE 'sound' END AS kind FROM f)
WHERE kind <> 'blank' GROUP BY kind
"""))
def _src_corrupt_capture(spark, sf):
    """Bronze keeps every line that is not blank, the corrupt text in a column of its own."""
    landing = land_lines(spark, sf, faults=True)
    bronze, state = scratch_dir(spark, "bronze"), scratch_dir(spark, "state")
    medallion.write_bronze(files.landed_stream(spark, landing), bronze, state)
    table = spark.read.schema(S.BRONZE).parquet(bronze)
    kind = F.when(F.col("_corrupt_record").isNotNull(), F.lit("corrupt")) \
        .when(files.record_fault(), F.lit("other shape")).otherwise(F.lit("sound"))
    return table.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("lines"))


@query("silver_quarantine", using("f", body="""
SELECT kind, count(*) AS records FROM (SELECT CASE kafka_offset % 53 WHEN 0 THEN 'not JSON'
  WHEN 1 THEN 'not a record' WHEN 2 THEN 'blank' WHEN 3 THEN 'no stop id'
  WHEN 4 THEN 'no observation time' ELSE 'observation' END AS kind FROM f)
WHERE kind <> 'blank' GROUP BY kind
"""))
def _silver_quarantine(spark, sf):
    """Silver and what it leaves out: together all of Bronze. Few files per core and batch; the
    watermark covers the seven years that the rows span."""
    landing = land_lines(spark, sf, faults=True, file_records=_FILE_RECORDS)
    few = files_at_once(spark, 2)
    bronze, silver, aside, state = (
        scratch_dir(spark, n) for n in ("bronze", "silver", "quarantine", "state"))
    medallion.write_bronze(files.landed_stream(spark, landing, max_files=few), bronze,
                           f"{state}/bronze")
    medallion.write_silver(medallion.bronze_stream(spark, bronze, max_files=few), silver,
                           f"{state}/silver", watermark="4000 days", quarantine=aside)
    kept = spark.read.parquet(silver).select(F.lit("observation").alias("kind"))
    return kept.unionByName(spark.read.parquet(aside).select(F.col("reason").alias("kind"))) \
        .groupBy("kind").agg(F.count(F.lit(1)).alias("records"))


@query("silver_evolution", using("f", body=f"""
SELECT stop_id, {text("observed_at - INTERVAL 2 HOUR")} AS observed_at,
  CASE WHEN stop_index % 3 = 1 THEN brand END AS brand,
  CASE WHEN stop_index % 3 = 1 THEN train_filter END AS train_filter,
  train_number, stop_index
FROM f
"""))
def _silver_evolution(spark, sf):
    """Three runs on one checkpoint; only the second knows of the columns brand and filter.

    Few files per core and batch, as in `src_landing_stream`.
    """
    few = files_at_once(spark, 2)
    landing, bronze, silver, state = (
        scratch_dir(spark, n) for n in ("landing", "bronze", "silver", "state"))
    rows = frames.payloads(spark, sf)
    early = S.T.StructType([f for f in S.PAYLOAD if f.name not in ("brand", "train_filter")])
    for number, payload in enumerate((early, S.PAYLOAD, early)):
        records = frames.records(rows.filter(F.col("stop_index") % 3 == number))
        with spent_shuffles(spark):
            records.select(F.to_json(F.struct(*S.RECORD_COLUMNS)).alias("value")) \
                .write.option("compression", "gzip").option("maxRecordsPerFile", _FILE_RECORDS) \
                .text(f"{landing}/delivery={number}")
        medallion.write_bronze(files.landed_stream(spark, landing, max_files=few), bronze,
                               f"{state}/bronze")
        medallion.write_silver(medallion.bronze_stream(spark, bronze, max_files=few), silver,
                               f"{state}/silver", watermark="4000 days", payload=payload)
    return medallion.silver_table(spark, silver).select(
        "stop_id", "observed_at", "brand", "train_filter", "train_number",
        "stop_index")


@query("stream_dedup", using("f", body=f"""
SELECT DISTINCT stop_id, {text("observed_at")} AS observed_at, trip_id, station_name FROM f
"""))
def _stream_dedup(spark, sf):
    """Every observation delivered twice, kept once.

    Lines and orders are read and joined once for both deliveries.
    """
    rows = stop_stream(spark, sf).select("stop_id", "observed_at", "trip_id", "station_name")
    twice = rows.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    out, state = scratch_dir(spark, "dedup"), scratch_dir(spark, "state")
    medallion.drain(medallion.deduplicated(twice), out, state)
    return spark.read.parquet(out)


# Two deliveries: first the even order lines, then the odd ones.
_LATE = f"""
WITH first AS (SELECT stop_id, observed_at FROM f WHERE stop_index % 2 = 0),
second AS (SELECT stop_id, observed_at FROM f WHERE stop_index % 2 = 1)
SELECT stop_id, {text("observed_at")} AS observed_at FROM first
UNION ALL
SELECT stop_id, {text("observed_at")} FROM second
WHERE observed_at > (SELECT max(observed_at) - INTERVAL 730 DAY FROM first)
"""


@query("stream_late_drop", using("f", body=_LATE))
def _stream_late_drop(spark, sf):
    """A second delivery after a restart; rows behind the watermark of the first are lost."""
    source, out, state = (scratch_dir(spark, n) for n in ("late", "out", "state"))
    rows = frames.observations(spark, sf).select("stop_id", "observed_at", "stop_index")
    for number, odd in enumerate((0, 1)):
        rows.filter(F.col("stop_index") % 2 == odd).drop("stop_index") \
            .write.parquet(f"{source}/delivery={number}")
        stream = spark.readStream.schema("stop_id STRING, observed_at TIMESTAMP, delivery INT") \
            .parquet(source).drop("delivery")
        medallion.drain(medallion.deduplicated(stream, "730 days"), out, state)
    return spark.read.parquet(out)


@query("stream_resume", using("f", body=f"""
SELECT stop_id, {text("observed_at")} AS observed_at, stop_index % 2 AS delivery FROM f
"""))
def _stream_resume(spark, sf):
    """Three runs on one checkpoint, two deliveries: each file is taken once."""
    source, out, state = (scratch_dir(spark, n) for n in ("resume", "out", "state"))
    rows = frames.observations(spark, sf).select("stop_id", "observed_at", "stop_index")
    for odd in (0, 1, None):
        if odd is not None:
            rows.filter(F.col("stop_index") % 2 == odd).drop("stop_index") \
                .write.parquet(f"{source}/delivery={odd}")
        stream = spark.readStream.schema("stop_id STRING, observed_at TIMESTAMP, delivery INT") \
            .parquet(source)
        medallion.drain(stream, out, state)
    return spark.read.parquet(out)


@query("stream_bounded_batches", using("f", body="""
SELECT trip_id, count(*) AS records, min(kafka_offset) AS first_offset FROM f GROUP BY trip_id
"""))
def _stream_bounded_batches(spark, sf):
    """One file per core and micro-batch: many small batches, the same records."""
    landing = land_lines(spark, sf, file_records=_FILE_RECORDS)
    bronze, state = scratch_dir(spark, "bronze"), scratch_dir(spark, "state")
    one = files_at_once(spark, 1)
    medallion.write_bronze(files.landed_stream(spark, landing, max_files=one), bronze, state)
    return spark.read.schema(S.BRONZE).parquet(bronze).select(
        F.regexp_extract("key", r"^(.*)-[^-]*-[^-]*$", 1).alias("trip_id"), "offset"
    ).groupBy("trip_id").agg(F.count(F.lit(1)).alias("records"),
                             F.min("offset").alias("first_offset"))


def _poll_columns(events):
    return frames.as_polls(events).withColumn("digest", content_digest("content")) \
        .select("key", "cycle", "position", "content", "digest")


@query("stream_change_filter", using("polls", body=CHANGE_SQL))
def _stream_change_filter(spark, sf):
    """Two runs on one checkpoint, one file per micro-batch, dealt out by event: every cycle
    is spread over many batches and both runs."""
    source, out, kept, state = (
        scratch_dir(spark, n) for n in ("polls", "changed", "kept", "state"))
    rows = _poll_columns(frames.table(spark, sf, "events"))
    cycles = scratch_dir(spark, "cycles")
    rows.groupBy("cycle").agg(F.count("*").alias("rows")).write.parquet(cycles)
    schema = "key BIGINT, cycle INT, position BIGINT, content STRING, digest STRING, part INT"
    for number in range(2):
        rows.filter(F.col("position") % 2 == number).repartition(2, "position") \
            .write.parquet(f"{source}/part={number}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1") \
            .parquet(source).drop("part")
        changes.filter_changes(stream, cycles, out, kept, state)
    return spark.read.parquet(out).select(
        F.col("key").cast("long").alias("key"), "cycle", "position", "content")


@query("stream_empty_cycle", using("polls", body="""
WITH days AS (SELECT DISTINCT cycle AS day FROM polls WHERE cycle % 7 <> 3),
numbered AS (SELECT day, row_number() OVER (ORDER BY day) AS no FROM days),
rows AS (SELECT p.key, p.cycle AS day, n.no, p.position, p.content
  FROM polls p JOIN numbered n ON n.day = p.cycle WHERE p.cycle % 5 <> 0),
state AS (SELECT key, no, arg_max(content, position) AS content FROM rows GROUP BY 1, 2),
changed AS (SELECT s.key, s.no FROM state s LEFT JOIN state p
  ON p.key = s.key AND p.no = s.no - 1 AND p.content = s.content WHERE p.key IS NULL)
SELECT key, day, cast(no AS bigint) AS cycle, position FROM rows JOIN changed USING (key, no)
"""))
def _stream_empty_cycle(spark, sf):
    """Every fifth poll is empty and clears the state, every seventh fails and does not."""
    events = frames.table(spark, sf, "events")
    rows = _poll_columns(events).withColumnRenamed("cycle", "day")
    days = rows.select(F.col("day").alias("poll")).distinct().withColumn(
        "ok", F.col("poll") % 7 != 3)
    numbered = number_cycles(days).withColumnRenamed("poll", "day")
    filled = rows.filter("day % 5 <> 0").join(numbered, "day")
    source, out, kept, state = (
        scratch_dir(spark, n) for n in ("polls", "changed", "kept", "state"))
    filled.repartition(3, "position").write.parquet(source)
    cycles = scratch_dir(spark, "cycles")
    numbered.join(filled.groupBy("cycle").agg(F.count("*").alias("rows")), "cycle", "left") \
        .select("cycle", F.coalesce("rows", F.lit(0)).cast("long").alias("rows")) \
        .write.parquet(cycles)
    stream = spark.readStream.schema(
        "day INT, key BIGINT, position BIGINT, content STRING, digest STRING, cycle INT"
    ).option("maxFilesPerTrigger", "1").parquet(source)
    changes.filter_changes(stream, cycles, out, kept, state)
    return spark.read.parquet(out).select(
        F.col("key").cast("long").alias("key"), "day", "cycle", "position")


def _event_records(events):
    return events.select(
        F.lit("events").alias("topic"), (F.col("user_id") % 2).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.unix_millis(F.col("ts").cast("timestamp"))
        .alias("timestamp"), F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"))


# Records per landing file in the registered query.
_RUN = 50_000


@query("sink_landing_batches", f"""
SELECT printf('events-p%d-%012d-%012d', p, min(event_id), max(event_id)) AS batch,
  count(*) AS records, min(event_id) AS first_offset, max(event_id) AS last_offset
FROM (SELECT *, user_id % 2 AS p FROM events) GROUP BY p, event_id // {_RUN}
""")
def _sink_landing_batches(spark, sf):
    """A record stream as offset-named gzip batches."""
    landing, state = scratch_dir(spark, "landing"), scratch_dir(spark, "state")
    batches.land_stream(_event_records(table_stream(spark, sf, "events")), landing, state, _RUN)
    return _landed(spark, landing).groupBy("batch").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"))


def _landed(spark, landing):
    name = F.regexp_extract(F.col("_metadata.file_path"), r"batch=([^/]+)/", 1)
    return files._permissive(spark.read).load(landing).withColumn("batch", name)


@query("stream_replay_idempotent", """
SELECT concat('', user_id % 2) AS partition, count(*) AS records, count(DISTINCT event_id) AS offsets
FROM events GROUP BY user_id % 2
""")
def _stream_replay_idempotent(spark, sf):
    """The same micro-batch landed twice, as after a crash before the commit."""
    landing = scratch_dir(spark, "landing")
    step = batches.land(landing, _RUN)
    for _ in range(2):
        step(_event_records(frames.table(spark, sf, "events")), 0)
    return _landed(spark, landing).groupBy(F.col("partition").cast("string").alias("partition")) \
        .agg(F.count(F.lit(1)).alias("records"), F.count_distinct("offset").alias("offsets"))


@query("stream_from_landing_batches", """
SELECT user_id AS key, count(*) AS records, cast(sum(epoch_us(ts) // 1000) AS bigint) AS time_sum
FROM events GROUP BY user_id
""")
def _stream_from_landing_batches(spark, sf):
    """Record stream -> landing batches -> Bronze stream: nothing lost, nothing twice."""
    landing, bronze, state = (scratch_dir(spark, n) for n in ("landing", "bronze", "state"))
    batches.land_stream(_event_records(table_stream(spark, sf, "events")), landing,
                        f"{state}/land", _RUN)
    medallion.write_bronze(files.landed_stream(spark, landing), bronze, f"{state}/bronze")
    return spark.read.schema(S.BRONZE).parquet(bronze).groupBy(
        F.col("key").cast("long").alias("key")).agg(
        F.count(F.lit(1)).alias("records"), F.sum("timestamp").alias("time_sum"))

