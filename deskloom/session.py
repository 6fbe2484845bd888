"""Session settings every job and view relies on."""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

SETTINGS = {
    # Epoch columns become wall-clock timestamps at UTC whatever the host's zone is.
    "spark.sql.session.timeZone": "UTC",
    # Joins carry no broadcast hints: a side is broadcast only when its measured size is
    # under spark.sql.autoBroadcastJoinThreshold, and a hot shuffle partition is split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows are several times as large in a task as in a shuffle file: this bounds what a task sorts.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
}

# For sessions that load: rows of few values take some bytes each in a parquet file and fifty times that in a
# broadcast table, so whether one is small is judged by more than the size of its files. For the same reason a task
# reads less of them, so that tasks are many and even. Records are written apart by table without being sorted by it:
# there are fewer tables than writers, and what a task writes is bounded by what it reads.
READ_BYTES = "spark.sql.files.maxPartitionBytes"
LOAD_SETTINGS = {
    "spark.sql.sources.fileCompressionFactor": "16.0",
    READ_BYTES: "8m",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session and return it."""
    return _apply(spark, SETTINGS)


def configure_stream(spark: SparkSession) -> SparkSession:
    """Size the tasks that a stream of landed files reads in: it goes by the session it was defined in, while it runs."""
    return _apply(spark, {READ_BYTES: LOAD_SETTINGS[READ_BYTES]})


def configure_load(spark: SparkSession) -> SparkSession:
    """As :func:`configure`, with :data:`LOAD_SETTINGS`."""
    return _apply(configure(spark), LOAD_SETTINGS)


@contextmanager
def load_settings(spark: SparkSession) -> Iterator[None]:
    """:data:`LOAD_SETTINGS` for a while."""
    before = {name: spark.conf.get(name, None) for name in LOAD_SETTINGS}
    _apply(spark, LOAD_SETTINGS)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _apply(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark


# Target size of a shuffle partition. Adaptive execution merges small ones, so the start may be generous.
PARTITION_BYTES = 64 * 1024 * 1024
# Landed pages may be compressed, to a tenth or less.
LANDED = 8


def scale_to(spark: SparkSession, *paths: str, times: int = 1) -> int:
    """Let shuffles start with enough partitions for the data under the paths; returns the number.

    The session's own ``spark.sql.shuffle.partitions`` is the least. ``times`` is how much larger the data is than its files.
    """
    held = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        held += files.getContentSummary(path).getLength()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), held * times // PARTITION_BYTES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the context's checkpoint folder,
    else one beside the tables of the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_runs").rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, for one run; it is deleted when the driver exits."""
    folder = f"{shared_folder(spark)}/run-{uuid4()}"
    atexit.register(_delete, spark, folder)
    return folder


def _delete(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is not None and spark.sparkContext._jsc is not None:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
