"""Record stream to landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import write_landing_batches

# Records per landing file at most. Gzip files cannot be split, so they stay small.
BATCH_RECORDS = 500_000


def _complete(spark, path: str) -> bool:
    """A finished write leaves a marker next to its files."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def land(path: str, batch_records: int = BATCH_RECORDS):
    """The `foreachBatch` function that lands one micro-batch under `path/drain=<n>`.

    The offsets are committed after it returns. A micro-batch that is run again after a
    crash holds the same records: if its first run finished, it is left alone, so a stream
    that has read those files does not meet them again under other names; if not, it is
    replaced.
    """
    def step(records: DataFrame, number: int) -> None:
        target = f"{path}/drain={number}"
        if not _complete(records.sparkSession, target):
            write_landing_batches(records, target, batch_records)

    return step


def land_stream(records: DataFrame, path: str, checkpoint: str,
                batch_records: int = BATCH_RECORDS) -> StreamingQuery:
    """Drain a record stream into landing files, then stop."""
    query = (
        records.writeStream.foreachBatch(land(path, batch_records))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
