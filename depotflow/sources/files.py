"""Delimited files in, star tables and exports out."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from depotflow.functions.calendar import to_moment
from depotflow.session import FREE_SHUFFLES, with_settings

# Position of a row in its file, captured at the scan.
SCAN_ORDER = ("_file", "_block", "_row")


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw CSV with a header, every column as text in the file's own column order.

    Columns a contract does not know are kept, missing ones stay missing (the data
    quality report names them).  Nothing is inferred, so only the header is read ahead.
    ``multi_line`` accepts line breaks inside quoted values at the price of files that
    cannot be split.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    locale: str = "en-US",
    date_format: str | None = None,
) -> DataFrame:
    """CSV with a header and declared column types.

    ``locale`` is the language tag that numbers and month names are written in, e.g. en-IN for
    1,00,000.50 or de-DE for 100.000,50; ``date_format`` the pattern of date columns where it is not
    ISO.  Spark's reader applies a locale to decimals and dates alone, so columns declared as float or
    double are read as decimals first; integers are read as written.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    real = [f.name for f in schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if locale == "en-US" or not real:
        declared = schema
    else:
        wide = T.DecimalType(38, 10)
        declared = T.StructType([T.StructField(f.name, wide if f.name in real else f.dataType) for f in schema.fields])
    reader = spark.read.option("header", True).option("locale", locale)
    if date_format is not None:
        reader = reader.option("dateFormat", date_format)
    df = reader.schema(declared).csv(path)
    if declared is schema:
        return df
    return df.withColumns({n: F.col(f"`{n}`").cast(schema[n].dataType) for n in real})


def with_scan_order(df: DataFrame) -> DataFrame:
    """Add columns that order rows as they stand in the files, for keep-first rules.

    ``monotonically_increasing_id`` only orders rows within one file split; file path
    and block start order the splits, so the result does not depend on how the scan
    packs splits into tasks.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(SCAN_ORDER[0]),
        F.col("_metadata.file_block_start").alias(SCAN_ORDER[1]),
        F.monotonically_increasing_id().alias(SCAN_ORDER[2]),
    )


def without_scan_order(df: DataFrame) -> DataFrame:
    return df.drop(*SCAN_ORDER)


def restore_dates(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Re-type date columns after a round trip through text."""
    present = [d for d in dates if d in df.columns]
    return df.withColumns({d: to_moment(df, d).cast("date") for d in present})


#: Shuffle data of a task that writes a stored table, and of one that also sorts and widens the rows of its join.
FILE_BYTES, JOINED_BYTES = "32m", "16m"

#: File of a table folder that names the version to read.
POINTER = "CURRENT"


def _paths(spark: SparkSession, path: str):
    """Hadoop's path class, the file context of ``path``, and the options of a rename that replaces."""
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(
        fs.Path(path).toUri() if "://" in path else fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri(),
        spark._jsc.hadoopConfiguration(),
    )
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    return fs.Path, context, options


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the committed version of a table; None before the first commit."""
    Path, context, _ = _paths(spark, path)
    if not context.util().exists(Path(f"{path}/{POINTER}")):
        return None
    return f"{path}/{spark.read.text(f'{path}/{POINTER}').first()[0]}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed version of a table that ``write_table`` wrote."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no committed table in {path}")
    return spark.read.parquet(version)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = "financial_year",
    pack: bool = False,
    task_bytes: str = FILE_BYTES,
) -> int:
    """Full replace of one table, partitioned so that year filters prune files.

    The new version is written beside the old one and counted while it is written; once the stored rows
    (from the Parquet footers) equal that count, a small pointer file is replaced by a rename, and
    readers of ``read_table`` follow it.  A write that fails, or a driver lost in between, leaves the old
    version in place.  The version before stays for readers that have opened it; older ones go.

    A task writes one file for each year among its rows.  Rows come from an exchange that AQE packs to
    ``task_bytes`` of shuffle data for a task, so files stay large without another exchange of the whole
    table.  ``pack`` adds that exchange: large years are split over several tasks, small ones packed, as
    pays where years are many.  Files are compressed with zstd.  Returns the row count.
    """
    spark = df.sparkSession
    counter = Observation()
    partitioned = partition_by is not None and partition_by in df.columns
    if partitioned and pack:
        df = df.hint("rebalance", partition_by)
    name = f"v-{uuid.uuid4().hex}"
    writer = df.observe(counter, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd")
    if partitioned:
        writer = writer.partitionBy(partition_by)
    with with_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": task_bytes} | FREE_SHUFFLES):
        writer.parquet(f"{path}/{name}")
        rows = counter.get["rows"]
        _commit(spark, path, name, rows, df.schema)
    return rows


def _commit(spark: SparkSession, path: str, name: str, rows: int, schema: T.StructType) -> None:
    """Make a written version the current one, if it holds the rows that were counted."""
    there = spark.read.schema(schema).parquet(f"{path}/{name}").count()
    if there != rows:
        raise OSError(f"{path}: {rows} rows were written, {there} are stored; the table was not replaced")
    Path, context, overwrite = _paths(spark, path)
    before = current_version(spark, path)
    draft = f"{path}/.{name}.pointer"
    spark.range(1).select(F.lit(name)).coalesce(1).write.text(draft)
    part = next(
        f.getPath() for f in context.util().listStatus(Path(draft)) if f.getPath().getName().startswith("part-")
    )
    context.rename(part, Path(f"{path}/{POINTER}"), overwrite)
    context.delete(Path(draft), True)
    kept = {name, before.rsplit("/", 1)[-1] if before else name}
    for entry in context.util().listStatus(Path(path)):
        folder = entry.getPath().getName()
        if folder.startswith("v-") and folder not in kept:
            context.delete(entry.getPath(), True)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV copy with a header.  One part per task: the mart queries end in a handful of
    partitions, and facts must never be squeezed through a single task.

    ``compression`` is a codec of Spark's writer (gzip: ``.csv.gz``); ``read_raw`` reads the parts all the same.
    """
    df.write.mode("overwrite").option("header", True).csv(path, compression=compression)


def load_report(spark: SparkSession, written: Mapping[str, tuple[int, str]]) -> DataFrame:
    """Compare the rows each load saw (``{name: (rows, path)}``) with the stored table.

    The stored side is counted from the Parquet footers; the source is not read again.
    """
    parts = []
    for name, (expected, path) in written.items():
        stored = read_table(spark, path).agg(F.count(F.lit(1)).alias("loaded_rows"))
        parts.append(
            stored.select(
                F.lit(name).alias("table_name"), F.lit(expected).alias("expected_rows"), "loaded_rows"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("verified", F.col("expected_rows") == F.col("loaded_rows"))


def export_all(
    spark: SparkSession,
    exports: Mapping[str, Callable[[], DataFrame]],
    folder: str,
    workers: int = 4,
    compression: str | None = None,
) -> DataFrame:
    """Write every named table or view as CSV; one failure skips only that item.

    ``workers`` exports run side by side, each in a scheduler pool of its own: small marts fill the
    cores that the tail of a large one leaves idle (with ``spark.scheduler.mode=FAIR`` they share
    all of them).  ``compression`` as for ``write_csv``.  An export's shuffle files go when it ends.  Returns the
    manifest in the order given: name, status, column count and message.
    """

    def export(item: tuple[str, Callable[[], DataFrame]]) -> tuple:
        name, build = item
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"export-{name}")
        try:
            df = build()
            write_csv(df, f"{folder}/{name}", compression)
            return name, "exported", len(df.columns), None
        except Exception as error:  # noqa: BLE001 - any failure is reported, not raised
            return name, "skipped", None, str(error)

    with with_settings(spark, FREE_SHUFFLES), ThreadPoolExecutor(max_workers=workers) as pool:
        manifest = list(pool.map(inheritable_thread_target(spark)(export), exports.items()))
    return spark.createDataFrame(
        manifest, "name string, status string, columns int, message string"
    )


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows under an explicit order."""
    return df.orderBy(*order).limit(n)


def literal_table(
    spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType
) -> DataFrame:
    """A small dimension given in code."""
    return spark.createDataFrame(list(rows), schema)


def days(lo: dt.date, hi: dt.date, spark: SparkSession) -> DataFrame:
    """Calendar days of a configured range as column ``date_key``."""
    bounds = spark.range(1).select(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_key"))
