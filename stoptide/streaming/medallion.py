"""Landing -> Bronze -> Silver."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from .. import schemas as S
from ..plans.silver import silver, silver_quarantine
from ..session import lean_stream
from ..sources import evolution, sinks
from ..sources.files import record_fault

# Kafka keeps three days; a replay of all of it must not fall behind the watermark.
DEFAULT_WATERMARK = "4 days"


class _Dropped(StreamingQueryListener):
    """Adds up what a query dropped for being late, over all of its batches.

    A query itself remembers only its newest progress reports.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: set[str] = set()
        self.news = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.rows[run] = self.rows.get(run, 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def total(self, run: str) -> int:
        with self.news:
            self.news.wait_for(lambda: run in self.ended, timeout=60)
        return self.rows.get(run, 0)


_dropped: dict[str, int] = {}
# Files that one batch of Silver writes for a day at most, if not told otherwise.
DAY_SLICES = 8


def drain(stream: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet",
          partition_by: list[str] | None = None, **options: str) -> StreamingQuery:
    """Append everything present to `path`, then stop. Returns the finished query.

    What it needs beside the rows is kept small (`session.lean_stream`).
    """
    writer = (
        stream.writeStream.format(fmt).outputMode("append").options(**sinks.dense(fmt))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    for key, value in options.items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    listener = _Dropped()
    streams = stream.sparkSession.streams
    streams.addListener(listener)
    try:
        with lean_stream(stream.sparkSession):
            query = writer.start(path)
        query.awaitTermination()
        _dropped[str(query.runId)] = listener.total(str(query.runId))
    finally:
        streams.removeListener(listener)
    return query


def sound(records: DataFrame) -> DataFrame:
    return records.filter(~record_fault())


def write_bronze(stream: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Append landed records unchanged, faulty ones included; Silver separates them."""
    return drain(stream, path, checkpoint, **kw)


def bronze_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The Bronze table as a stream."""
    reader = spark.readStream.schema(S.BRONZE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def deduplicated(observations: DataFrame, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """One row per (stop_id, observed_at); the watermark bounds the state.

    Rows later than the watermark are dropped: `late_rows` reports how many.
    """
    return observations.withWatermark("observed_at", watermark) \
        .dropDuplicates(["stop_id", "observed_at"])


def write_silver(bronze: DataFrame, path: str, checkpoint: str,
                 watermark: str = DEFAULT_WATERMARK, by_date: bool = False,
                 quarantine: str | None = None, payload: T.StructType = S.PAYLOAD,
                 day_slices: int = DAY_SLICES, **kw) -> StreamingQuery:
    """Type, deduplicate and append.

    The columns that come of `payload` are declared first (`sources.evolution`): a run may bring
    new ones or lack some that the table has, on the same checkpoint; a column of another type
    stops it before it writes. `silver_table` reads all rows with all columns.

    With `by_date` the table is partitioned by the day of the observation, so jobs over a
    range of days read only those; the rows of a day are gathered in `day_slices` tasks before
    they are written, else every task would write a file for every day. A replay of few days
    needs as many slices as it has cores for each. `quarantine` is the path that the records left
    out are appended to, with the reason, by a stream of its own over the same Bronze table.
    """
    spark = bronze.sparkSession
    if quarantine is not None:
        drain(silver_quarantine(bronze), quarantine, f"{checkpoint}-quarantine")
    rows = deduplicated(silver(sound(bronze), payload), watermark)
    if by_date:
        slice_ = F.pmod(F.xxhash64("stop_id"), F.lit(day_slices))
        rows = rows.withColumn("observed_date", F.to_date("observed_at")).repartition(
            F.col("observed_date"), slice_)
        kw["partition_by"] = ["observed_date"]
    evolution.declare(spark, path, rows.schema)
    return drain(rows, path, checkpoint, **kw)


def silver_table(spark: SparkSession, path: str) -> DataFrame:
    """Silver with all columns that any run has written."""
    return evolution.read(spark, path)


def silver_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream."""
    return evolution.stream(spark, path, max_files)


def late_rows(query: StreamingQuery) -> int:
    """Rows a drained query dropped for being behind the watermark, over all its batches."""
    return _dropped[str(query.runId)]
