"""Writers of tables, daily JSON lines and landing batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S

# The codec of stored Parquet tables. Rows of stops, records and routes take about half of what
# they take by Spark's default.
DENSE = "zstd"


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gather the rows of each partition value before a partitioned write.

    Without it every task writes a file into every directory. Unlike a plain repartition,
    the adaptive rebalance splits values that hold much data and merges small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df


def dense(fmt: str) -> dict[str, str]:
    """The writer's option for DENSE; other formats keep their own."""
    return {"compression": DENSE} if fmt == "parquet" else {}


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def overwrite_table(df: DataFrame, table: str, *, fmt: str = "parquet",
                    partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (),
                    sort_by: Sequence[str] = (), buckets: int = 0) -> None:
    """Replace a table together with its schema, in one write.

    With `buckets` the table is stored hashed by `bucket_by`, and later windows and joins on
    those columns read it without a shuffle. The rows are dealt out by the same hash first, so
    that a bucket is one file.
    """
    rows = df.repartition(buckets, *bucket_by) if buckets else by_partition(df, partition_by)
    writer = rows.write.mode("overwrite").format(fmt) \
        .options(**dense(fmt)) \
        .option("overwriteSchema", "true") \
        .option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)


def overwrite_path(df: DataFrame, path: str, *, fmt: str = "parquet",
                   partition_by: Sequence[str] = ()) -> None:
    writer = by_partition(df, partition_by).write.mode("overwrite").format(fmt) \
        .option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_ordered(df: DataFrame, path: str) -> None:
    """Store rows in the order they have: `df` is sorted, and files and rows follow that order."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_jsonl_daily(observations: DataFrame, path: str, moment: str = "observed_at") -> None:
    """Append JSON lines under one directory per UTC day, NULL fields written out.

    An empty batch writes no data file.
    """
    day = F.date_format(F.col(moment).cast("timestamp"), "yyyy-MM-dd")
    (
        by_partition(observations.withColumn("dt", day), ["dt"])
        .write.mode("append").partitionBy("dt")
        .option("ignoreNullFields", "false").json(path)
    )


def write_jsonl_run(observations: DataFrame, path: str, run: int, moment: str = "observed_at"
                    ) -> None:
    """JSON lines of one run under `path/run=<n>`, a directory per UTC day, NULLs written out.

    The run's directory is replaced as a whole: repeated, a run leaves its lines once.
    """
    day = F.date_format(F.col(moment).cast("timestamp"), "yyyy-MM-dd")
    (
        by_partition(observations.withColumn("dt", day), ["dt"])
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .option("ignoreNullFields", "false").partitionBy("dt").json(f"{path}/run={run}")
    )


def batch_name(topic, partition, first, last):
    """Made of offsets, never of the clock, so a replay produces the same name."""
    return F.format_string("%s-p%d-%012d-%012d", topic, partition, first, last)


def with_batch(records: DataFrame, batch_records: int) -> DataFrame:
    """Add the name of the landing batch each record belongs to.

    Batches are runs of at most `batch_records` offsets of one partition, so a partition
    that holds most of the records is spread over as many batches as it needs. A group of
    the window is one such run: offsets are unique within a partition, so its size is bounded
    by the parameter.
    """
    run = F.floor(F.col("offset") / batch_records)
    whole_run = Window.partitionBy("topic", "partition", run)
    return records.withColumn("batch", batch_name(
        F.col("topic"), F.col("partition"),
        F.min("offset").over(whole_run), F.max("offset").over(whole_run),
    ))


def write_landing_batches(records: DataFrame, path: str, batch_records: int) -> None:
    """Gzip JSON lines under `path/batch=<name>/`, instead of what `path` held before.

    The finished write leaves Spark's `_SUCCESS` marker in `path`.
    """
    line = F.to_json(F.struct(*S.RECORD_COLUMNS), {"ignoreNullFields": "false"})
    (
        with_batch(records, batch_records)
        .select(line.alias("value"), "batch")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .option("compression", "gzip").partitionBy("batch").text(path)
    )
