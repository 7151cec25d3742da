"""The change filter with state that the engine keeps per key.

Three stateful steps, all closed by one watermark over the cycles: the last digest of every key
and cycle (an aggregate, combined before the shuffle), the comparison with the key's cycle before
(state of the key: one cycle and its digest), and the join of the rows with what has changed. A
batch reads and writes the state of its own keys only, in RocksDB, however many rows wait.

`changes.filter_changes` closes a cycle when the rows that its table announces are there; here a
cycle is closed when rows of a cycle more than `lateness` after it have come. Rows of closed
cycles are dropped by the watermark and counted by the engine.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..session import lean_stream

# A cycle is an hour on the clock of the watermark, whenever it was polled. Its rows are dated
# in the middle, as rows at the watermark itself count as late.
_HOUR, _MIDDLE = 3600, 1800
_TICK = "\0tick"


class CycleComparison(StatefulProcessor):
    """One row per key and cycle in, those out that differ from the cycle right before.

    The state is forgotten by a timer once the next cycle is closed, as only it can be compared
    with: keys that went away leave nothing behind.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "cycle INT, digest STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.last.get()            # None without state; every call leaves the process
        for row in sorted(rows, key=lambda r: r["cycle"]):
            cycle, digest = row["cycle"], row["digest"]
            if known is None or known[0] != cycle - 1 or known[1] != digest:
                yield Row(key=key[0], cycle=cycle, at=row["at"])
            known = (cycle, digest)
        if known is not None:
            self.last.update(known)
            self.handle.registerTimer((known[0] + 3) * _HOUR * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.last.get()
        if known is not None and (known[0] + 3) * _HOUR * 1000 <= \
                expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def changed_keys(rows: DataFrame) -> DataFrame:
    """(key, cycle, at) that differ from the cycle before; `rows` has a watermark on `at`."""
    closed = rows.groupBy(
        "key", "cycle", F.window("at", f"{_HOUR} seconds")).agg(
        F.max_by("digest", "position").alias("digest"))
    states = closed.select("key", "cycle", "digest", F.window_time("window").alias("at"))
    return states.groupBy("key").transformWithState(
        CycleComparison(), "key STRING, cycle INT, at TIMESTAMP", "append", "eventTime",
        eventTimeColumnName="at")


def changes(rows: DataFrame, lateness: int = 1) -> DataFrame:
    """The stream of rows (key, cycle, position, digest, …) whose content has changed.

    `cycle` counts the successful polls. An empty poll, and the end of the stream, are told by a
    row without a key. Rows may come in any order and any cut as long as none is more than
    `lateness` cycles behind the newest; rows of one key in one cycle share the digest of the
    last of them, and a key that was away for a cycle is changed when it returns.
    """
    at = F.timestamp_seconds(F.col("cycle").cast("long") * _HOUR + _MIDDLE)
    # Ticks have to reach the watermark: a test of the key alone would be pushed below it.
    real = (F.col("key") != _TICK) | F.col("at").isNull()
    timed = rows.withColumn("key", F.coalesce(F.col("key").cast("string"), F.lit(_TICK))) \
        .withColumn("cycle", F.col("cycle").cast("int")).withColumn("at", at) \
        .withWatermark("at", f"{lateness * _HOUR + 1} seconds").filter(real)
    changed = changed_keys(timed).select(
        F.col("key").alias("_key"), F.col("cycle").alias("_cycle"), F.col("at").alias("_at"))
    # the comparison of a cycle is dated at the end of its hour
    same = (F.col("key") == F.col("_key")) & (F.col("cycle") == F.col("_cycle")) \
        & (F.col("_at") >= F.col("at")) & (F.col("_at") < F.col("at") + F.expr("INTERVAL 1 HOUR"))
    return timed.join(changed, same).drop("_key", "_cycle", "_at", "at")


def filter_changes(rows: DataFrame, out: str, checkpoint: str, lateness: int = 1
                   ) -> StreamingQuery:
    """Drain `rows` and append what changed to `out`; the checkpoint keeps the state."""
    writer = changes(rows, lateness).writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with lean_stream(rows.sparkSession, counted=True):
        query = writer.start(out)
    query.awaitTermination()
    return query
