"""Counters per poll cycle, kept up to date while the rows come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import versions

TABLE = "cycle"
# Versions that stay for readers that have begun; one batch makes one.
KEEP_VERSIONS = 24
_KEY = ["window_start", "cycle"]


def counted(rows: DataFrame, watermark: str, width: str) -> DataFrame:
    """Seen, written and suppressed rows per window and cycle, as a stream of updates.

    `rows` carries cycle, observed_at and written (was the row emitted). The watermark bounds the
    state: a window that it has passed is final, and later rows of it are dropped.
    """
    return rows.withWatermark("observed_at", watermark).groupBy(
        F.window("observed_at", width), "cycle").agg(
        F.count(F.lit(1)).alias("seen"), F.count_if("written").alias("written")).select(
        F.col("window.start").alias("window_start"), "cycle", "seen", "written",
        (F.col("seen") - F.col("written")).alias("suppressed"))


def upsert(root: str):
    """The `foreachBatch` function that puts updated counters in the place of earlier ones.

    An update holds whole new values, so a batch that is run again after a crash changes nothing.
    The table has one row per cycle and window; every batch publishes it anew
    (`sources.versions`), and a reader goes on with the version it began with, for KEEP_VERSIONS
    batches.
    """
    def step(updates: DataFrame, number: int) -> None:
        draft = versions.Draft(updates.sparkSession, root)
        before = draft.read(TABLE)
        updates = updates.persist()
        try:
            if updates.isEmpty() and before is not None:
                return
            rows = updates if before is None else before.join(
                updates.select(*_KEY), _KEY, "left_anti").unionByName(updates)
            draft.replace(TABLE, rows.coalesce(1))
            draft.publish()
            versions.clean(updates.sparkSession, root, keep=KEEP_VERSIONS)
        finally:
            updates.unpersist()

    return step


def count_cycles(rows: DataFrame, root: str, checkpoint: str, watermark: str = "2 hours",
                 width: str = "1 hour") -> StreamingQuery:
    """Drain `rows` into the counters under `root`, then stop."""
    query = counted(rows, watermark, width).writeStream.outputMode("update") \
        .foreachBatch(upsert(root)).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def cycle_table(spark: SparkSession, root: str) -> DataFrame:
    """(cycle, seen, written, suppressed) as far as rows have come in."""
    rows = versions.read(spark, root, TABLE)
    if rows is None:
        raise ValueError(f"nothing has been counted under {root}")
    return rows.groupBy("cycle").agg(*[F.sum(c).alias(c)
                                       for c in ("seen", "written", "suppressed")])
