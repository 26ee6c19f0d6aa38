"""Calendar columns: April-start financial year on top of the plain calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


MONTHS = "January February March April May June July August September October November December"
DAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday"


def _pick(names: str, position: Column) -> Column:
    """Name by 1-based position.  The split of a literal is folded to a constant array,
    so a row pays for a lookup only, far less than formatting the date."""
    return F.element_at(F.split(F.lit(names), " "), position)


def to_moment(df: DataFrame, name: str, formats: tuple[str, ...] = ()) -> Column:
    """Coerce a column to a zone-free timestamp; anything unparseable becomes null."""
    col = F.col(f"`{name}`")
    if df.schema[name].dataType.typeName() != "string":
        return col.cast("timestamp_ntz")
    tries = [col.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def financial_year(date: Column) -> Column:
    """'FY2023-24' for April 2023 to March 2024."""
    start = F.year(F.add_months(date, -3))
    tail = F.lpad(((start + 1) % 100).cast("string"), 2, "0")
    return F.concat(F.lit("FY"), start.cast("string"), F.lit("-"), tail)


def financial_year_days(label: str) -> tuple[dt.date, dt.date]:
    """First and last day of 'FY2023-24'."""
    start = int(label[2:6])
    return dt.date(start, 4, 1), dt.date(start + 1, 3, 31)


def in_financial_years(date: Column, labels: Sequence[str]) -> Column:
    """Days of the given financial years, as ranges of the date that a scan can use."""
    out = F.lit(False)
    for first, last in sorted(financial_year_days(x) for x in set(labels)):
        out = out | date.between(F.lit(first), F.lit(last))
    return out


def quarter_label(date: Column) -> Column:
    """Calendar quarter (April is Q2), although the financial year starts in April."""
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def month_name(date: Column) -> Column:
    return _pick(MONTHS, F.month(date))


def day_name(date: Column) -> Column:
    return _pick(DAYS, F.weekday(date) + 1)


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def season(month: Column) -> Column:
    return (
        F.when(month.isin(3, 4, 5), "Summer")
        .when(month.isin(6, 7, 8, 9), "Monsoon")
        .when(month.isin(10, 11), "Autumn")
        .otherwise("Winter")
    )


def period_columns(date: Column) -> dict[str, Column]:
    """The redundant period columns that every fact carries."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "month_name": month_name(date),
        "quarter": quarter_label(date),
        "financial_year": financial_year(date),
    }


def period_label(month_name_col: Column, year: Column, sep: str = " ") -> Column:
    """'Apr 2023' style axis label."""
    return F.concat(F.left(month_name_col, F.lit(3)), F.lit(sep), year.cast("string"))


def period_sort(year: Column, month: Column) -> Column:
    return year * 100 + month


def month_index(year: Column, month: Column) -> Column:
    """Consecutive month number, so that ranges over it are calendar ranges."""
    return year * 12 + month
