"""Session settings the jobs are designed around."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings.  AQE coalesces the many small post-shuffle partitions,
# splits hot join partitions (also when the split costs one more exchange) and
# turns a join into a broadcast only after measuring the side's real size.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle data and Parquet files are compressed: a task's rows take up to a hundred times as many bytes
    # in its sorts and hash tables, and Spark's 64 and 128 MB a task would be gigabytes there.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.files.maxPartitionBytes": "32m",
}

# Bytes of compressed input tables for each shuffle partition, and the number of partitions that the input's
# size alone asks for at most (more input makes them larger).
PARTITION_BYTES, MOST_PARTITIONS = 4 << 20, 20_000

#: Shuffle files go when the job that needed them ends, not when the driver's memory is next collected: of
#: several tables written one after the other, only one has its shuffles on disk.  For writes, not for rows that
#: are asked for again.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Set when the session is built: checkpoints go once nothing refers to them.
START_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app_name: str = "depotflow", **settings: object) -> SparkSession:
    """Create a session with the library's settings; ``settings`` override them.

    Keyword names use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions=8``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in (SQL_SETTINGS | START_SETTINGS).items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Set the number of shuffle partitions so that one holds about ``target_bytes`` when
    everything is shuffled; AQE coalesces where a stage turns out smaller."""
    partitions = max(spark.sparkContext.defaultParallelism, -(-input_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return partitions


def size_for_tables(spark: SparkSession, paths: Iterable[str]) -> int:
    """Raise the number of shuffle partitions to what the stored tables' size asks for; never lower it.

    A fixed number lets the memory of one task grow with the input.  Tables that are absent count nothing.
    """
    conf = spark._jsc.hadoopConfiguration()
    stored_bytes = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(conf)
        if files.exists(path):
            stored_bytes += files.getContentSummary(path).getLength()
    wanted = min(-(-stored_bytes // PARTITION_BYTES), MOST_PARTITIONS)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return partitions


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for the jobs inside; the ones before come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.  Where none is set, a fresh local folder in
    local mode; on a cluster that is an error, for executors would each fill their own disk."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="depotflow-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    Used where several steps must see the same rows of an expensive aggregate: the
    stored rows survive the loss of an executor and are never computed twice.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
