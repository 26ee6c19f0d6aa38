"""Exact distinct counts that merge: bitmaps of whole-number ids, kept per group and joined upwards.

A count of distinct ids per month does not add up to one per year.  A bitmap per month does: a year's is the OR
of its months.  An id is one bit of a bucket of 32,768 ids, so a group that holds a third of all rows is spread
over as many buckets as it has ids, and a task holds one bitmap of 4 KB at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T


def bitmap_mart(df: DataFrame, keys: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """One row per group, counted column and bucket of its ids: keys, ``counted``, ``bucket``, ``bits``.

    Each counted column is a group-by of its own, combined on the map side; facts are not copied per column.  A
    null id is in no bitmap; a group with null ids only has an empty one.  Other than whole numbers are refused.
    """
    for c in counted:
        if not isinstance(df.schema[c].dataType, T.IntegralType):
            raise ValueError(f"{c} is not a whole number: it has no bit of its own")
    parts = []
    for c in counted:
        id_ = F.col(c).cast("bigint")
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("bits")
        by = df.groupBy(*keys, F.bitmap_bucket_number(id_).alias("bucket")).agg(bits)
        parts.append(by.select(*keys, F.lit(c).alias("counted"), "bucket", "bits"))
    return reduce(DataFrame.unionByName, parts)


def merged_bitmaps(mart: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A mart over fewer keys, from the stored one alone."""
    return mart.groupBy(*keys, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(mart: DataFrame, keys: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts per group; ``names`` maps the result's columns to counted ones.

    Without keys there is one row, also of an empty mart.
    """
    merged = merged_bitmaps(mart, keys)
    ones = F.bitmap_count("bits")
    return merged.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("counted") == column, ones)), F.lit(0)).alias(name)
            for name, column in names.items()
        ]
    )
