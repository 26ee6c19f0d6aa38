"""Slicer predicates: member filters that apply before any aggregate or top-n."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from depotflow.functions.calendar import in_financial_years


def slice_rows(df: DataFrame, **members: object) -> DataFrame:
    """Keep rows whose columns match; a list means any of, None means all.

    ``slice_rows(sales, financial_year=["FY2023-24"], category=None)``
    """
    for column, wanted in members.items():
        if wanted is None:
            continue
        if column == "financial_year" and "date" in df.columns:
            # The scan knows dates, not years, so the years go to it as date ranges too.
            years = [wanted] if isinstance(wanted, str) else list(wanted)
            df = df.filter(in_financial_years(F.col("date"), years))
        if isinstance(wanted, str) or not isinstance(wanted, Iterable):
            df = df.filter(F.col(column) == F.lit(wanted))
        else:
            df = df.filter(F.col(column).isin(*wanted))
    return df


def same_text(column: str, value: str):
    """Case-insensitive equality, as the semantic model compares text."""
    return F.lower(F.col(column)) == F.lit(value.lower())
