"""Named measures, evaluated for any grouping (the grouping is the filter context)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.numeric import half_up, ladder, ladder_up, percent, ratio
from depotflow.operators.ranking import dense_rank_all, dense_rank_small, top_rank
from depotflow.operators.rollup import rollup
from depotflow.operators.slicers import same_text
from depotflow.operators.timeline import (
    daily_totals,
    dense,
    growth,
    month_number,
    monthly_totals,
    rolling_mean,
    shifted,
    to_date_totals,
)

SCALE = 4

# Status texts of the traffic lights, with their default thresholds.
EFFICIENCY_STATUS = ((95, "✅ On Target"), (90, "⚠️ Below Target")), "❌ Critical"
COLLECTION_STATUS = ((90, "✅ Healthy"), (80, "⚠️ Watch")), "❌ At Risk"
DSO_STATUS = ((15, "✅ Good"), (30, "⚠️ Moderate")), "❌ High"
EFFICIENCY_TARGET = 95


def efficiency_status(value: Column, rules=EFFICIENCY_STATUS) -> Column:
    return ladder(value, *rules)


def collection_status(value: Column, rules=COLLECTION_STATUS) -> Column:
    return ladder(value, *rules)


def dso_status(value: Column, rules=DSO_STATUS) -> Column:
    return ladder_up(value, *rules)


# Sales ------------------------------------------------------------------------


def sales_measures(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    out = rollup(
        sales,
        keys,
        {
            "total_revenue": ("sum", "net_amount"),
            "total_gross_revenue": ("sum", "gross_amount"),
            "total_discount": ("sum", "discount"),
            "total_qty_sold": ("sum", "quantity"),
            "total_invoices": ("distinct", "invoice_number"),
            "total_customers": ("distinct", "customer_id"),
        },
    )
    return out.withColumns(
        {
            "avg_invoice_value": ratio(F.col("total_revenue"), F.col("total_invoices"), SCALE),
            "discount_pct": percent(F.col("total_discount"), F.col("total_gross_revenue"), SCALE),
        }
    )


def _revenue_by(
    sales: DataFrame, keys: Sequence[str], period: str, at: Column, dimension: tuple[DataFrame, str] | None
) -> DataFrame:
    """Revenue per key and period; attributes of ``dimension`` are joined after folding by its key."""
    dated = sales.withColumn(period, at)
    return rollup(dated, [*keys, period], {"revenue": ("sum", "net_amount")}, dimension)


def revenue_to_date(
    sales: DataFrame, keys: Sequence[str] = (), dimension: tuple[DataFrame, str] | None = None
) -> DataFrame:
    """Daily revenue with month-to-date and financial-year-to-date totals, per ``keys`` where given.

    A key has a row for every day from its first to its last one.
    """
    if keys:
        totals = _revenue_by(sales, keys, "date_key", F.col("date").cast("date"), dimension)
        daily = dense(totals, keys, "date_key", "revenue", "day")
    else:
        daily = daily_totals(sales, "net_amount", "revenue")
    return to_date_totals(daily, "revenue", "revenue_mtd", "revenue_ytd", keys)


def monthly_time_intelligence(
    sales: DataFrame, keys: Sequence[str] = (), dimension: tuple[DataFrame, str] | None = None
) -> DataFrame:
    """Monthly revenue: same month last year, MoM %, YoY %, rolling 3-month average, per ``keys`` where given.

    A key has a row for every month from its first to its last one.
    """
    if keys:
        month = F.trunc(F.col("date").cast("date"), "month")
        totals = _revenue_by(sales, keys, "month_start", month, dimension)
        monthly = dense(totals, keys, "month_start", "revenue", "month")
    else:
        monthly = monthly_totals(sales, "net_amount", "revenue")
    # One column for all windows, so that they share one sort.
    monthly = monthly.withColumn("_month", month_number())
    monthly = shifted(monthly, "revenue", 12, "revenue_smly", keys, "_month")
    monthly = shifted(monthly, "revenue", 1, "revenue_previous_month", keys, "_month")
    monthly = rolling_mean(monthly, "revenue", 3, "_rolling", keys, "_month")
    revenue = F.col("revenue")
    return monthly.withColumns(
        {
            "revenue_mom_pct": growth(revenue, F.col("revenue_previous_month")),
            "revenue_yoy_pct": growth(revenue, F.col("revenue_smly")),
            "revenue_3m_rolling_avg": half_up(F.col("_rolling"), SCALE),
        }
    ).drop("_rolling", "_month")


def revenue_rank(
    sales: DataFrame,
    key: str,
    small: bool = False,
    dimension: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """Dense rank of ``key`` by revenue.  Ranking by a name merges equal names; rank by
    the id to keep them apart.  ``small=True`` only for a key of fixed small domain."""
    totals = rollup(sales, [key], {"total_revenue": ("sum", "net_amount")}, dimension)
    rank = dense_rank_small if small else dense_rank_all
    return rank(totals, "total_revenue", "revenue_rank")


def top_n_customers(sales: DataFrame, n: int, key: str = "customer_id") -> DataFrame:
    """Customers whose standard rank by revenue is at most ``n`` (ties included)."""
    totals = sales.groupBy(key).agg(F.sum("net_amount").alias("total_revenue"))
    return top_rank(totals, "total_revenue", n, "customer_rank")


# Production -------------------------------------------------------------------


def production_measures(
    runs: DataFrame, keys: Sequence[str], target: float = EFFICIENCY_TARGET
) -> DataFrame:
    out = runs.groupBy(*keys).agg(
        F.sum("planned_qty").alias("total_planned_qty"),
        F.sum("actual_qty").alias("total_actual_qty"),
        F.sum("wastage_qty").alias("total_wastage_qty"),
        F.sum("raw_milk_used_l").alias("total_raw_milk_used_l"),
        F.sum("net_produced_qty").alias("_net"),
    )
    planned, actual = F.col("total_planned_qty"), F.col("total_actual_qty")
    efficiency = percent(actual, planned, SCALE)
    return out.withColumns(
        {
            "production_efficiency_pct": efficiency,
            "wastage_rate_pct": percent(F.col("total_wastage_qty"), actual, SCALE),
            "yield_efficiency_pct": percent(F.col("_net"), F.col("total_raw_milk_used_l"), SCALE),
            "efficiency_vs_target": efficiency - F.lit(target),
            "efficiency_status": efficiency_status(efficiency),
        }
    ).drop("_net")


# Stock ------------------------------------------------------------------------


def inventory_measures(stock: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stock measures in one two-level aggregate: per group and date, then per group.

    Three turnover definitions exist side by side: this one divides by the average of
    daily totals, ``monthly_turnover`` averages rows, ``guide_inventory_fields`` halves
    the grand sums.
    """
    daily = stock.groupBy(*dict.fromkeys([*keys, "date"])).agg(
        F.sum("closing_stock").alias("_closing"),
        F.sum("dispatched_qty").alias("_out"),
        (F.sum("opening_stock") + F.sum("closing_stock")).alias("_both"),
        F.count_if(F.col("stock_status") == "Stockout").alias("_stockouts"),
    )
    out = daily.groupBy(*keys).agg(
        F.max_by("_closing", "date").alias("current_closing_stock"),
        F.sum("_out").alias("_out"),
        F.sum("_both").alias("_both"),
        F.count(F.lit(1)).alias("_days"),
        F.sum("_stockouts").alias("stockout_days"),
    )
    days = F.col("_days").cast("double")
    pace = F.col("_out").cast("double") / days
    held = F.col("_both").cast("double") / F.lit(2.0) / days
    return out.withColumns(
        {
            "avg_daily_dispatch": half_up(pace, SCALE),
            "days_of_stock": ratio(F.col("current_closing_stock"), pace, SCALE),
            "stock_turnover_ratio": ratio(F.col("_out"), held, SCALE),
        }
    ).drop("_out", "_both", "_days")


def guide_inventory_fields(stock: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct-date stockout rate and grand-sum turnover."""
    daily = stock.groupBy(*dict.fromkeys([*keys, "date"])).agg(
        F.max(F.when(F.col("stock_status") == "Stockout", 1).otherwise(0)).alias("_out_of_stock"),
        F.sum("opening_stock").alias("_open"),
        F.sum("closing_stock").alias("_close"),
        F.sum("dispatched_qty").alias("_sent"),
    )
    out = daily.groupBy(*keys).agg(
        F.sum("_out_of_stock").alias("stockout_days"),
        F.count(F.lit(1)).alias("_days"),
        (F.sum("_open") + F.sum("_close")).alias("_both"),
        F.sum("_sent").alias("_sent"),
    )
    average = F.col("_both").cast("double") / F.lit(2.0)
    return out.withColumns(
        {
            "stockout_rate_pct": percent(F.col("stockout_days"), F.col("_days"), SCALE),
            "avg_inventory": average,
            "turnover_ratio": ratio(F.col("_sent"), average, SCALE),
        }
    ).drop("_days", "_both", "_sent")


# Receivables ------------------------------------------------------------------


def accounts_measures(accounts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Receivables measures; status texts compare without regard to case."""
    open_ = F.col("outstanding_balance")
    overdue = same_text("payment_status", "Overdue")
    oldest = same_text("aging_bucket", "90+ Days")
    paid_days = F.when(~overdue, F.col("days_to_payment"))
    out = accounts.groupBy(*keys).agg(
        F.sum("invoice_amount").alias("total_billed"),
        F.sum("amount_paid").alias("total_collected"),
        F.sum(open_).alias("total_outstanding"),
        F.sum(F.when(overdue, open_)).alias("overdue_amount"),
        F.count_if(overdue).alias("overdue_invoice_count"),
        F.sum(F.when(oldest, open_)).alias("overdue_90_plus"),
        ratio(F.sum(paid_days), F.count(paid_days), SCALE).alias("avg_days_to_pay"),
    )
    billed = F.col("total_billed")
    efficiency = percent(F.col("total_collected"), billed, SCALE)
    dso = ratio(F.col("total_outstanding").cast("double") * F.lit(30.0), billed, SCALE)
    return out.withColumns(
        {
            "collection_efficiency_pct": efficiency,
            "dso": dso,
            "overdue_pct": percent(F.col("overdue_amount"), billed, SCALE),
            "collection_status": collection_status(efficiency),
            "dso_status": dso_status(dso),
        }
    )
