"""Production KPI marts over ``fact_production``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.numeric import percent
from depotflow.functions.text import with_percent_sign
from depotflow.operators.reshape import pivot_value
from depotflow.operators.share import share_percent

MONTH = ["year", "month", "month_name", "quarter", "financial_year"]
YEARS = (2023, 2024, 2025)

_TOTALS: Mapping[str, str] = {
    "total_planned": "planned_qty",
    "total_actual": "actual_qty",
    "total_wastage": "wastage_qty",
    "total_net_produced": "net_produced_qty",
    "raw_milk_used_l": "raw_milk_used_l",
}
_RATES: Mapping[str, tuple[str, str]] = {
    "efficiency_pct": ("total_actual", "total_planned"),
    "wastage_pct": ("total_wastage", "total_actual"),
    "yield_pct": ("total_net_produced", "raw_milk_used_l"),
}


def _rated_totals(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summed quantities with rates taken as sum over sum."""
    totals = runs.groupBy(*keys).agg(*[F.sum(src).alias(n) for n, src in _TOTALS.items()])
    return totals.withColumns(
        {n: percent(F.col(a), F.col(b)) for n, (a, b) in _RATES.items()}
    ).withColumn("raw_milk_used_l", F.round("raw_milk_used_l", 2))


def monthly_production(runs: DataFrame) -> DataFrame:
    return _rated_totals(runs, MONTH).orderBy("year", "month")


def category_efficiency(runs: DataFrame) -> DataFrame:
    out = _rated_totals(runs, ["year", "category"]).drop("total_net_produced")
    return out.withColumnRenamed("raw_milk_used_l", "total_raw_milk_l").orderBy(
        "year", F.col("efficiency_pct").desc_nulls_first(), "category"
    )


def yield_by_year(
    runs: DataFrame, keys: Sequence[str], years: Sequence[int] = YEARS, prefix: str = "yield_"
) -> DataFrame:
    """Yield percentage with one column per year (years are given, not discovered)."""
    yearly = _rated_totals(runs, [*keys, "year"])
    names = {y: f"{prefix}{y}" for y in years}
    return pivot_value(yearly, keys, "year", names, "yield_pct").orderBy(*keys)


def efficiency_bands(runs: DataFrame) -> DataFrame:
    """Distribution of runs over efficiency bands; runs without a band are left out."""
    out = (
        runs.filter(F.col("efficiency_band").isNotNull())
        .groupBy("efficiency_band")
        .agg(F.count(F.lit(1)).alias("production_runs"))
        .withColumn("run_share", share_percent("production_runs"))
    )
    return out.withColumn("pct_of_runs", with_percent_sign(F.col("run_share"))).orderBy(
        F.col("production_runs").desc(), "efficiency_band"
    )


def shift_performance(runs: DataFrame) -> DataFrame:
    out = runs.groupBy("shift").agg(
        F.count(F.lit(1)).alias("production_runs"),
        percent(F.sum("actual_qty"), F.sum("planned_qty")).alias("avg_efficiency_pct"),
        percent(F.sum("wastage_qty"), F.sum("actual_qty")).alias("avg_wastage_pct"),
        F.sum("actual_qty").alias("total_produced"),
    )
    return out.withColumn("production_share_pct", share_percent("total_produced")).orderBy(
        F.col("avg_efficiency_pct").desc_nulls_first(), "shift"
    )


def runs_on_days_with_only(runs: DataFrame, present: str, absent: str) -> DataFrame:
    """All runs of days that have runs in one shift and none in the other."""

    def in_shift(name: str) -> Column:
        return F.count_if(F.col("shift") == name)

    days = (
        runs.groupBy("date")
        .agg(in_shift(present).alias("_have"), in_shift(absent).alias("_lack"))
        .filter("_have > 0 AND _lack = 0")
    )
    return runs.join(days.select("date"), "date", "left_semi").orderBy("date")
