"""The change filter as a stream: only whole cycles are compared.

How micro-batches cut the rows must not matter. The cycles table says how many rows each cycle
has; rows are staged until all rows of their cycle, and of all cycles before it, are there.
Closed cycles then go through the batch operator, once, against the state that the last closed
cycle left behind. A key that dominates is handled by aggregation and joins and never walks
through one task.

Output, state and staged rows carry the number of the micro-batch: a batch that is run again
after a crash reads what the one before it left and overwrites its own results.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import changed_since_previous, cycle_state, merge_state

_STATE = "key STRING, cycle INT, digest STRING"


def _slot(path: str, batch: int) -> str:
    """Two alternating places: a rerun of batch n finds the state of n-1 untouched."""
    return f"{path}/slot={batch % 2}"


def _closed_upto(staged: DataFrame, cycles: DataFrame, last: int | None) -> int | None:
    """The last cycle up to which every cycle has all its rows."""
    there = staged.groupBy("cycle").agg(F.count(F.lit(1)).alias("there"))
    known = cycles.select(F.col("cycle").cast("int").alias("cycle"), "rows")
    if last is not None:
        known = known.filter(F.col("cycle") > last)
    status = known.join(there, "cycle", "full").select(
        "cycle", (F.col("rows").isNull() | (F.coalesce("there", F.lit(0)) < F.col("rows")))
        .alias("open"))
    first_open, final = status.agg(
        F.min(F.when(F.col("open"), F.col("cycle"))), F.max("cycle")).first()
    if first_open is not None:
        return max(first_open - 1, last) if last is not None else first_open - 1
    return final if final is not None else last


def filter_changes(rows: DataFrame, cycles: str, out: str, state: str,
                   checkpoint: str) -> StreamingQuery:
    """Drain `rows` (key, cycle, position, digest, …) and append what changed to `out`.

    `cycles` is the path of a Parquet table (cycle, rows): the successful polls, empty ones
    included, and how many rows each has. Rows may arrive in any order and any cut; those of a
    cycle that is not complete, or not in the table, wait under `state`. Rows of a cycle that
    is closed already are more than the table announced: they are written to
    `state/surplus/batch=<n>` and change nothing. Each batch writes `out/batch=<n>`.
    """
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _slot(state, number - 1)
        # Read several times below: parse and join the batch once. Blocks of a lost executor
        # are computed again from the source's files.
        current = batch.withColumn("key", F.col("key").cast("string")) \
            .withColumn("cycle", F.col("cycle").cast("int")) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            previous, last, staged = None, None, current
            if number:
                previous = spark.read.schema(_STATE).parquet(f"{before}/state")
                last = spark.read.schema("upto INT").parquet(f"{before}/upto").first()["upto"]
                staged = current.unionByName(
                    spark.read.schema(current.schema).parquet(f"{before}/staged"))
            if last is not None:
                surplus = staged.filter(F.col("cycle") <= last)
                surplus.write.mode("overwrite").parquet(f"{state}/surplus/batch={number}")
                staged = staged.filter(F.col("cycle") > last)
            upto = _closed_upto(staged, spark.read.parquet(cycles), last)
            closed = staged.filter(F.col("cycle") <= F.lit(upto))
            changed_since_previous(closed, previous) \
                .write.mode("overwrite").parquet(f"{out}/batch={number}")

            after = _slot(state, number)
            merge_state(cycle_state(closed), previous).drop("current") \
                .filter(F.col("cycle") == F.lit(upto)) \
                .write.mode("overwrite").parquet(f"{after}/state")
            waiting = staged if upto is None else staged.filter(F.col("cycle") > upto)
            waiting.write.mode("overwrite").parquet(f"{after}/staged")
            spark.range(1).select(F.lit(upto).cast("int").alias("upto")) \
                .write.mode("overwrite").parquet(f"{after}/upto")
        finally:
            current.unpersist()

    query = (
        rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
