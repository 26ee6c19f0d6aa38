"""Pivot, unpivot and trend lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def pivot_value(
    df: DataFrame, keys: Sequence[str], column: str, names: Mapping[object, str], value: str
) -> DataFrame:
    """One output column per listed value of ``column``.

    The values are listed up front, so Spark plans one aggregate and never runs a job
    just to discover them.
    """
    wide = df.groupBy(*keys).pivot(column, list(names)).agg(F.max(value))
    return wide.withColumnsRenamed({str(k): v for k, v in names.items()})


def measures_as_rows(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], kind: str = "decimal(38,4)"
) -> DataFrame:
    """Measure names and values: one row per key and measure."""
    typed = df.select(*keys, *[F.col(m).cast(kind).alias(m) for m in measures])
    return typed.unpivot(list(keys), list(measures), "measure", "value")


def trend_line(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept per group."""
    return df.groupBy(*keys).agg(
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
    )


def attribute(name: str):
    """The single value of a column within a group, null where it is not unique."""
    return F.when(F.min(name) == F.max(name), F.min(name))
