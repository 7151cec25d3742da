"""Running totals and exact order statistics without a one-task window.

Both work on integer keys. A key is read as digits of 16 bits, from the highest: the running
total of a key is that of its higher digits, plus one among the keys that share them. No window
holds more than 65,536 rows, whatever the keys. Rows are counted per key first, so the data
itself never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import share

_DIGIT = 16


def running_total(counts: DataFrame, key: str, count: str = "n",
                  out: str = "running") -> DataFrame:
    """Add the running sum of `count` in the order of an integer key.

    `counts` has one row per key. A NULL key comes last. Keys of other types are refused.
    """
    kind = counts.schema[key].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"running totals need an integer key, {key} is {kind.simpleString()}")
    shifts = (48, 32, 16) if isinstance(kind, T.LongType) else (16,)
    known = counts.filter(F.col(key).isNotNull())
    number = F.col(key).cast("long")
    offsets = None
    for shift in shifts:
        sums = known.groupBy(F.shiftright(number, shift).alias("_high")).agg(
            F.sum(count).alias("_sum"))
        if offsets is None:
            order = Window.orderBy("_high")
            sums = sums.withColumn("_before", F.lit(0).cast("long"))
        else:
            order = Window.partitionBy("_parent").orderBy("_high")
            sums = sums.withColumn("_parent", F.shiftright("_high", _DIGIT)).join(
                offsets.select(F.col("_high").alias("_parent"),
                               F.col("_offset").alias("_before")), "_parent")
        earlier = F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, -1))
        offsets = sums.select("_high", (F.col("_before") + F.coalesce(earlier, F.lit(0)))
                              .alias("_offset"))
    inside = Window.partitionBy("_high").orderBy(key).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = known.withColumn("_high", F.shiftright(number, _DIGIT)).join(offsets, "_high") \
        .withColumn(out, F.col("_offset") + F.sum(count).over(inside)).drop("_high", "_offset")
    everything = F.coalesce(known.agg(F.sum(count)).scalar(), F.lit(0))
    return totals.unionByName(counts.filter(F.col(key).isNull()).withColumn(
        out, (everything + F.col(count)).cast(totals.schema[out].dataType)))


def discrete_quantiles(df: DataFrame, value: str, points: Sequence[float]) -> DataFrame:
    """The sorted values' element at `int(p * (n - 1))` for every point, exactly.

    Result: (point, value), no rows for no values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(
        F.count(F.lit(1)).alias("n"))
    wanted = F.array(*[F.lit(float(p)) for p in points])

    def lands_here(point):
        position = F.floor(point * (F.col("total") - 1))
        return (position < F.col("running")) & (position >= F.col("running") - F.col("n"))

    return (
        running_total(counts, value)
        .withColumn("total", counts.agg(F.sum("n")).scalar())
        .select(F.explode(F.filter(wanted, lands_here)).alias("point"),
                F.col(value).alias("value"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency and share of every value; NULL is a value.

    The total is summed from the counts, not from a second pass over the rows.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", share(F.col("n"), total))


def most_common(df: DataFrame, column: str, limit: int) -> DataFrame:
    """The most frequent values; ties go to the smaller value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last()).limit(limit)
