"""Emit only what differs from the previous poll cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import running_total


def number_cycles(polls: DataFrame) -> DataFrame:
    """(poll, ok) -> (poll, cycle): the number of successful polls up to this one.

    An empty successful poll counts and thereby clears the state of all keys; a failed one
    does not, so the poll after it is compared with the one before it. `poll` is an integer.
    """
    numbered = running_total(polls.filter("ok").withColumn("_one", F.lit(1)), "poll", "_one",
                             "cycle")
    return numbered.select("poll", F.col("cycle").cast("int").alias("cycle"))


def cycle_state(rows: DataFrame) -> DataFrame:
    """What each cycle leaves behind: one digest per key and cycle, the last row's."""
    return rows.groupBy("key", "cycle").agg(F.max_by("digest", "position").alias("digest"))


def merge_state(state: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """State of a batch (`current`) on top of what was known before it."""
    current = state.withColumn("current", F.lit(True))
    if earlier is None:
        return current
    kept = earlier.join(state.select("key", "cycle"), ["key", "cycle"], "left_anti")
    return current.unionByName(kept.withColumn("current", F.lit(False)))


def changed_since_previous(rows: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Rows whose content differs from the previous cycle's.

    `rows` is (key, cycle, position, digest, …). State is replaced by each cycle, not merged:
    a key that was absent for a cycle is emitted again when it returns. Rows of one key in
    one cycle share the digest of the last of them. `earlier` is state of past cycles,
    (key, cycle, digest).

    The comparison happens on one row per key and cycle, made by a map-side aggregation, so
    a key's window holds as many rows as there are cycles, however many rows it has. The rows
    then meet the result in a semi join, whose larger side Spark splits when a key dominates.
    """
    known = merge_state(cycle_state(rows), earlier)
    by_cycle = Window.partitionBy("key").orderBy("cycle")
    unchanged = (F.lag("cycle").over(by_cycle) == F.col("cycle") - 1) \
        & (F.lag("digest").over(by_cycle) == F.col("digest"))
    changed = known.withColumn("unchanged", F.coalesce(unchanged, F.lit(False))) \
        .filter("current AND NOT unchanged").select("key", "cycle")
    return rows.join(changed, ["key", "cycle"], "left_semi")


def cycle_counters(rows: DataFrame, emitted: DataFrame) -> DataFrame:
    """Seen, written and suppressed rows per cycle."""
    both = rows.select("cycle", F.lit(1).alias("seen"), F.lit(0).alias("written")).unionByName(
        emitted.select("cycle", F.lit(0).alias("seen"), F.lit(1).alias("written")))
    return both.groupBy("cycle").agg(
        F.sum("seen").alias("seen"), F.sum("written").alias("written"),
        (F.sum("seen") - F.sum("written")).alias("suppressed"))
