"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import SparkSession

# Settings every job needs. All can be changed on a running session.
REQUIRED = {
    # YYMMDDHHMM texts are shifted from Berlin time to UTC; that is only right when the
    # session itself reads and prints instants as UTC.
    "spark.sql.session.timeZone": "UTC",
    # State of the streaming deduplication lives outside the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings for sessions this package opens itself.
DEFAULTS = {
    **REQUIRED,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# The number of rows in a state store is a figure of the progress reports only, and costs a read
# before each write and removal.
_COUNTED_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
# Whether what a statement has shuffled is removed when the statement ends. Otherwise it stays on the
# executors' disks until the driver happens to collect its garbage.
_SPENT_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Batches that the checkpoint of a drained stream can be taken back by.
_RETAINED = 10

_local_scratch: dict[str, str] = {}


def build(master: str | None = None, shuffle_partitions: int | None = None,
          **extra: str) -> SparkSession:
    """A session with the package's settings; on a cluster, leave `master` unset.

    Give `shuffle_partitions` for the largest shuffle (its bytes / 128 MB): adaptive execution
    merges what is too small, it does not split an ordinary shuffle further. A streaming
    query keeps the number its checkpoint began with.
    """
    builder = SparkSession.builder.appName("stoptide")
    settings = {**DEFAULTS, **extra}
    if master:
        builder = builder.master(master)
        if master.startswith("local"):              # tests and the bench open no port
            settings.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session that somebody else opened."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def _unless_set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds inside; a session that has set it itself keeps its word."""
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


@contextmanager
def uncounted_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside do not count the rows of their state; a session that says itself
    whether to count them keeps its word. A stream takes the settings that it is started with."""
    with _unless_set(spark, _COUNTED_STATE, "false"):
        yield


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Statements and streams that run inside remove what they have shuffled when they end, a
    stream after each batch. A frame that is run twice computes its shuffles again. A session
    that says itself what to do keeps its word."""
    with _unless_set(spark, _SPENT_SHUFFLES, "true"):
        yield


@contextmanager
def lean_stream(spark: SparkSession, counted: bool = False) -> Iterator[None]:
    """What a stream that drains and stops takes beside its results is kept small for those started
    inside. A batch's shuffles go when it ends, state is not counted unless `counted`, and what the
    checkpoint keeps for going back are _RETAINED batches, not a hundred.

    State is in as many partitions as there are cores, if the session's shuffles have more: every
    batch opens and commits each store of each partition, whatever is in it, and each takes some
    ten MB on disk. A stream that has begun keeps the number its checkpoint began with.
    """
    wide, cores = shuffle_width(spark), spark.sparkContext.defaultParallelism
    with nullcontext() if counted else uncounted_state(spark), spent_shuffles(spark), \
            _unless_set(spark, "spark.sql.streaming.minBatchesToRetain", str(_RETAINED)):
        if wide > cores:
            spark.conf.set("spark.sql.shuffle.partitions", str(cores))
        try:
            yield
        finally:
            if wide > cores:
                spark.conf.set("spark.sql.shuffle.partitions", str(wide))


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"the session time zone must be UTC, it is {zone}")


def shuffle_width(spark: SparkSession) -> int:
    """The partitions that the session gives its largest shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder that `spark.checkpoint.dir` names.

    Only a local session may fall back to a temporary folder: on a cluster the executors
    do not share the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _local_scratch.get(app)
        if base is None or not os.path.isdir(base):
            base = _local_scratch[app] = tempfile.mkdtemp(prefix="stoptide-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
