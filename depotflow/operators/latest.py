"""Last-date snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def last_date(df: DataFrame, date: str = "date") -> Column:
    """The table's last date as a scalar subquery (pushed to the scan at run time)."""
    return df.agg(F.max(date)).scalar()


def on_last_date(df: DataFrame, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) == last_date(df, date))


def total_on_last_date(
    df: DataFrame, keys: Sequence[str], value: str, name: str, date: str = "date"
) -> DataFrame:
    """Sum of ``value`` on the last date *within each group*.

    Two plain aggregates: totals per (group, date), then the total of the last date.
    """
    daily = df.groupBy(*dict.fromkeys([*keys, date])).agg(F.sum(value).alias("_v"))
    return daily.groupBy(*keys).agg(F.max_by("_v", date).alias(name))
