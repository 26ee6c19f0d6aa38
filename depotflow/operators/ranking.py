"""Ranks over keys of unbounded number, without a one-task window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from depotflow.session import stored


def top_rows(df: DataFrame, value: str, n: int, tie_break: str) -> DataFrame:
    """The ``n`` largest rows; ``tie_break`` makes the choice among equals unique."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(tie_break)).limit(n)


def top_rank(df: DataFrame, value: str, n: int, name: str) -> DataFrame:
    """Rows whose standard rank (1,1,3) by descending ``value`` is at most ``n``.

    All rows above a value that ranks within ``n`` are themselves among the ``n``
    largest, so ranks come from those ``n`` rows alone; joining them back by value also
    returns every row tied at the threshold, however many there are.
    """
    head = df.select(value).filter(F.col(value).isNotNull())
    head = head.orderBy(F.col(value).desc()).limit(n)
    tally = head.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    above = W.orderBy(F.col(value).desc()).rowsBetween(W.unboundedPreceding, -1)
    ranks = tally.select(
        value, (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(name)
    )
    return df.join(F.broadcast(ranks), value)  # at most n rows


def dense_rank_small(df: DataFrame, value: str, name: str) -> DataFrame:
    """Dense rank for a key with a fixed small domain (routes, categories)."""
    return df.withColumn(name, F.dense_rank().over(W.orderBy(F.col(value).desc_nulls_last())))


def dense_rank_all(df: DataFrame, value: str, name: str, slices: int | None = None) -> DataFrame:
    """Dense rank (1,1,2) by descending ``value`` over any number of rows.

    Equal values share a rank, so only distinct values are ranked: Spark cuts them into ranges
    (``slices`` of them; as many as the session shuffles to unless given), every task numbers its
    own sorted range, and a range is shifted by the number of values in the ranges above it.
    The cut points stay with the range exchange, so the plan does not grow with the slices.  The rows
    and the numbered ranges are stored once, because counts and ranks must see the same ones.
    """
    rows = stored(df)
    values = rows.select(value).filter(F.col(value).isNotNull()).distinct()
    largest_first = F.col(value).desc()
    ranges = values.repartitionByRange(slices, largest_first) if slices else values.repartitionByRange(largest_first)
    # The id is the partition's number above 33 bits of the position inside it.
    placed = ranges.sortWithinPartitions(largest_first).withColumn("_id", F.monotonically_increasing_id())
    placed = stored(placed)
    numbered = placed.select(
        value,
        F.shiftright("_id", 33).alias("_slice"),
        (F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("_nth"),
    )
    above = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    )
    ranks = numbered.join(F.broadcast(offsets), "_slice").select(  # one row per slice
        value, (F.col("_above") + F.col("_nth")).alias(name)
    )
    return rows.join(ranks, value, "left")
