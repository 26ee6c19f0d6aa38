"""Time intelligence on a dense calendar, of a whole table or of every value of some keys.

Every window here runs over rows already aggregated to one per day or month (and key), so its
size is bounded by the calendar, not by the fact.  With keys, the windows are partitioned by
them: one exchange by key serves filling gaps, running totals, shifts and means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from depotflow.functions.calendar import financial_year
from depotflow.functions.numeric import percent


def day_spine(df: DataFrame, date: str = "date") -> DataFrame:
    """Every day between the first and the last date of ``df``, as column ``date_key``."""
    bounds = df.agg(F.min(date).cast("date").alias("lo"), F.max(date).cast("date").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_key"))


def daily_totals(df: DataFrame, value: str, name: str, date: str = "date") -> DataFrame:
    """Dense daily totals; days without rows carry null."""
    totals = df.groupBy(F.col(date).cast("date").alias("date_key")).agg(F.sum(value).alias(name))
    return day_spine(totals, "date_key").join(totals, "date_key", "left")


def dense(totals: DataFrame, keys: Sequence[str], at: str, value: str, step: str) -> DataFrame:
    """Every period from the first to the last one of each key; periods without a row carry null.

    ``totals`` has one row per key and period; ``step`` is ``day`` or ``month`` (periods are then first
    days).  Each row brings forth the gap behind it, so nothing is joined and null keys keep theirs.
    """
    rows = totals.withColumn("_next", F.lead(at).over(W.partitionBy(*keys).orderBy(at)))
    before = F.date_sub("_next", 1) if step == "day" else F.add_months("_next", -1)
    gap = F.sequence(at, F.coalesce(before, F.col(at)), F.expr(f"interval 1 {step}"))
    spread = rows.select(*keys, F.col(at).alias("_own"), F.col(value).alias("_value"), F.explode(gap).alias(at))
    return spread.select(*keys, at, F.when(F.col(at) == F.col("_own"), F.col("_value")).alias(value))


def to_date_totals(
    daily: DataFrame, value: str, mtd: str, ytd: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Month-to-date and financial-year-to-date running totals (year ends in March)."""
    day = F.col("date_key")
    upto = (W.unboundedPreceding, W.currentRow)
    month_w = W.partitionBy(*keys, F.trunc(day, "month")).orderBy("date_key").rowsBetween(*upto)
    year_w = W.partitionBy(*keys, financial_year(day)).orderBy("date_key").rowsBetween(*upto)
    return daily.withColumn(mtd, F.sum(value).over(month_w)).withColumn(
        ytd, F.sum(value).over(year_w)
    )


def monthly_totals(df: DataFrame, value: str, name: str, date: str = "date") -> DataFrame:
    """Dense monthly totals from the first to the last month; months without rows carry null."""
    start = F.trunc(F.col(date).cast("date"), "month").alias("month_start")
    totals = df.groupBy(start).agg(F.sum(value).alias(name))
    bounds = totals.agg(F.min("month_start").alias("lo"), F.max("month_start").alias("hi"))
    spine = bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month_start"))
    return spine.join(totals, "month_start", "left")


def month_number() -> Column:
    return F.year("month_start") * 12 + F.month("month_start")


def shifted(
    monthly: DataFrame, value: str, months: int, name: str, keys: Sequence[str] = (), month: str | None = None
) -> DataFrame:
    """The value ``months`` earlier, matched by date: a gap month gives null instead of
    silently taking the row before the gap.

    ``month`` names a column that has ``month_number``: windows ordered by one column share one sort.
    """
    if keys:
        then = W.partitionBy(*keys).orderBy(month or month_number()).rangeBetween(-months, -months)
        return monthly.withColumn(name, F.max(value).over(then))
    moved = monthly.select(
        F.add_months("month_start", months).alias("month_start"), F.col(value).alias(name)
    )
    return monthly.join(moved, "month_start", "left")


def growth(current: Column, previous: Column) -> Column:
    """Percent change against ``previous``; null when it is missing or zero."""
    return percent(current - previous, previous)


def rolling_mean(
    monthly: DataFrame, value: str, months: int, name: str, keys: Sequence[str] = (), month: str | None = None
) -> DataFrame:
    """Mean over the calendar months of the trailing window that have a value; ``month`` as for ``shifted``."""
    window = W.partitionBy(*keys).orderBy(month or month_number()).rangeBetween(-(months - 1), W.currentRow)
    mean = F.sum(value).over(window).cast("double") / F.count(value).over(window).cast("double")
    return monthly.withColumn(name, mean)


def previous_period(df: DataFrame, value: str, order: list[str], name: str) -> DataFrame:
    """Value of the preceding row in period order (row based: no gap handling)."""
    return df.withColumn(name, F.lag(value).over(W.orderBy(*order)))


def last_value(df: DataFrame, value: str, order: list[str]) -> Column:
    """Value in the last period, for use in an aggregate over ``df``."""
    return F.max_by(F.col(value), F.struct(*order))
