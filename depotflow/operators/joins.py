"""Joins of the star schema.

No join carries a broadcast hint unless its side is bounded by construction (a limit,
or one row per calendar period).  For dimensions Spark compares the side's size with
``spark.sql.autoBroadcastJoinThreshold`` (at planning, and again with AQE's measured
size) and otherwise shuffles both sides, splitting hot partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from depotflow.functions.numeric import ratio


def with_dimension(
    fact: DataFrame, dim: DataFrame, key: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Left join of the chosen dimension columns; every fact row survives."""
    keys = [key] if isinstance(key, str) else list(key)
    wanted = [c for c in columns if c not in keys]
    return fact.join(dim.select(*keys, *wanted), keys, "left")


def mean_per_group(df: DataFrame, key: str, value: str, name: str, scale: int) -> DataFrame:
    """Attach a per-key average to every row.

    Aggregate and join back rather than a window over the key: the aggregate combines
    on the map side, while a window would bring all rows of a hot key to one task.
    """
    mean = df.groupBy(key).agg(
        ratio(F.sum(value), F.count(value), scale).alias(name)
    )
    return df.join(mean, key, "left")


def selected_by(df: DataFrame, marks: DataFrame, on: Sequence[str]) -> DataFrame:
    """Action filter: keep the rows that match any of the selected marks."""
    return df.join(marks.select(*on).distinct(), list(on), "left_semi")


def relate(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Logical relationship: both sides already at ``keys`` grain, so nothing fans out."""
    return left.join(right.select(*keys, *measures), list(keys), "left")
