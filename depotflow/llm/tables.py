"""Intermediate tables in the shared folder, and keys for rows whose ids may be null or repeated."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Where it is unset, a temporary folder in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="corpus-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Let the driver drop what finished jobs left: Spark removes their broadcasts and shuffle files only when
    the collector of the driver's JVM has found the plans that held them."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, what: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    The rows survive the loss of executors, and later steps neither repeat the work nor see its lineage.
    """
    path = f"{shared_folder(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run in the shared folder, each removed when the run needs it no more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, what: str) -> DataFrame:
        """Write ``df`` as table ``what`` and read it from there."""
        df.write.parquet(f"{self.folder}/{what}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{what}")

    def drop(self, what: str) -> None:
        """Remove table ``what``; what was read from it must not be used again."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{what}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(*columns: str) -> list[Column]:
    """Two 64-bit hashes ``key_a`` and ``key_b`` of the columns' values, nulls apart from all values."""
    values = [F.struct(F.col(c).isNull(), F.col(c)) for c in columns]
    return [
        F.xxhash64(F.lit(1), *values).alias("key_a"),
        F.xxhash64(F.lit(2), *values).alias("key_b"),
    ]
