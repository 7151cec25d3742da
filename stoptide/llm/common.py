"""Helpers of the operators: arrow columns, stored tables, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

PIECE_BYTES = 4 << 20
BATCH_ROWS = 1024


def column(fn: Callable[..., pa.Array], ddl: str):
    """A vectorised column function that Spark evaluates once per row, never twice."""
    return F.arrow_udf(fn, ddl).asNondeterministic()


def small_batches(spark: SparkSession) -> SparkSession:
    """Let Spark hand texts to Python in batches of at most BATCH_ROWS rows.

    Its default of ten thousand rows is made for numbers; whole texts of that many rows would
    lie in the memory of every task several times.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def put(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with the column `name`, which replaces one of that name."""
    return df.withColumn(name, value)


def pieces(values: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string or binary array with at most `limit` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def hashed_sample(df: DataFrame, column: str, rows: int) -> list:
    """About the `rows` rows with the least hashes of a column, all if there are fewer.

    A threshold leaves about twice as many before they are ordered, so that what tasks send to
    the driver is bounded together, not each by itself.
    """
    total = df.count()
    place = F.pmod(F.xxhash64(column), F.lit(1 << 30))
    some = df.where(place <= F.lit(int((1 << 30) * min(1.0, 2 * rows / max(total, 1)))))
    return some.orderBy(F.xxhash64(column), column).limit(rows).collect()


def store(df: DataFrame, label: str) -> DataFrame:
    """`df`, written to the shared folder and read again: cuts the lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected `edges` (a, b): rows (node, component).

    The component is the smallest node. Nodes without an edge are not returned; null ends and
    loops are left out. Rounds of large and small stars, each a minimum per node and a join;
    the minima are written, so that adaptive execution can split the join of a hot node. Every
    round cuts its lineage. The number of rounds grows with the logarithm of the component.
    """
    state = store(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")
    while True:
        before = _digest(state)
        if not before[0]:
            break
        large = _star(state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                      large=True)
        small = _star(large, large=False)
        drop_stored(large)
        done = _digest(small) == before
        drop_stored(state)
        state = small
        if done:
            break
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(
        F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them: the larger, or the smaller ones."""
    least = store(edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
                  .withColumn("m", F.least("n", "m")), "least")
    joined = edges.join(least, F.col("a") == F.col("n"))
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ends = least.where("m < n").select(F.col("n").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ends = least.select(F.col("n").alias("a"), F.col("m").alias("b"))
    found = store(out.union(ends).distinct(), "star")
    drop_stored(least)
    return found
