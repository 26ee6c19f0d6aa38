"""Shares of a total over results that are already aggregated to a small grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from depotflow.functions.numeric import percent, ratio


def share_percent(value: str, within: Sequence[str] = (), scale: int = 2) -> Column:
    """Percent of the total over all rows, or over the rows of the same ``within`` group.

    Meant for aggregated rows (categories, routes, months): without ``within`` the
    window runs in one task.
    """
    return percent(F.col(value), F.sum(value).over(W.partitionBy(*within)), scale)


def share_fraction(value: str, within: Sequence[str] = (), scale: int = 2) -> Column:
    return ratio(F.col(value), F.sum(value).over(W.partitionBy(*within)), scale)


def share_of_all(df: DataFrame, value: str, name: str, scale: int = 2) -> DataFrame:
    """Percent of total for a key of unbounded size: the total comes from a scalar
    subquery, so the rows themselves stay distributed."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, percent(F.col(value), total, scale))
