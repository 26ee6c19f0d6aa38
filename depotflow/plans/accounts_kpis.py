"""Receivables KPI marts over ``fact_accounts``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.numeric import half_up, percent, ratio
from depotflow.functions.text import with_percent_sign
from depotflow.operators.rollup import rollup
from depotflow.operators.share import share_percent
from depotflow.plans.sales_kpis import CUSTOMER, MONTH, money

# Bucket order of the aging report.
AGING_ORDER = {"1-30 Days": 1, "31-60 Days": 2, "61-90 Days": 3, "90+ Days": 4}

_AMOUNTS = {
    "total_billed": ("sum", "invoice_amount"),
    "total_collected": ("sum", "amount_paid"),
}


def _efficiency(collected: str = "total_collected") -> Column:
    return percent(F.col(collected), F.col("total_billed"))


def billing_collections(accounts: DataFrame, bitmaps: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """``bitmaps``: a stored mart of customers that has the month among its keys.

    ``stored``, here and below: the invoices are a stored table, cheap to read several times.
    """
    out = rollup(
        accounts,
        MONTH,
        {
            "customers_billed": ("distinct", "customer_id"),
            **_AMOUNTS,
            "total_outstanding": ("sum", "outstanding_balance"),
        },
        bitmaps=bitmaps,
        apart=stored,
    )
    return out.withColumns(
        {
            "collection_efficiency_pct": _efficiency(),
            **{c: money(c) for c in ("total_billed", "total_collected", "total_outstanding")},
        }
    ).orderBy("year", "month")


def aging_position(bucket: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for name, position in AGING_ORDER.items():
        out = out.when(bucket == name, position)
    return out.otherwise(len(AGING_ORDER) + 1)


def receivables_aging(accounts: DataFrame, stored: bool = False) -> DataFrame:
    """Overdue invoices by age bucket."""
    out = rollup(
        accounts.filter(F.col("payment_status") == "OverDue"),
        ["aging_bucket"],
        {
            "invoices": ("rows",),
            "customers": ("distinct", "customer_id"),
            "outstanding_amount": ("sum", "outstanding_balance"),
        },
        apart=stored,
    )
    return out.withColumns(
        {
            "pct_of_total": share_percent("outstanding_amount"),
            "outstanding_amount": money("outstanding_amount"),
            "sort_order": aging_position(F.col("aging_bucket")),
        }
    ).orderBy("sort_order")


def customer_payment(accounts: DataFrame) -> DataFrame:
    """Payment behaviour per customer."""

    def with_status(name: str) -> Column:
        return F.count_if(F.col("payment_status") == name)

    out = accounts.groupBy(*CUSTOMER).agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.sum("invoice_amount").alias("total_billed"),
        F.sum("amount_paid").alias("total_paid"),
        F.sum("outstanding_balance").alias("outstanding_amount"),
        ratio(F.sum("days_to_payment"), F.count("days_to_payment"), 2).alias("avg_days_to_pay"),
        with_status("Paid").alias("on_time_count"),
        with_status("Paid Late").alias("paid_late_count"),
        with_status("OverDue").alias("overdue_count"),
    )
    return out.withColumns(
        {
            "collection_efficiency_pct": _efficiency("total_paid"),
            **{c: money(c) for c in ("total_billed", "total_paid", "outstanding_amount")},
        }
    ).orderBy(F.col("outstanding_amount").desc_nulls_first(), "customer_id")


def dso_monthly(accounts: DataFrame) -> DataFrame:
    """Days sales outstanding per month, on a 30-day month."""
    days = F.sum("outstanding_balance").cast("double") * F.lit(30.0)
    return (
        accounts.groupBy("year", "month", "month_name")
        .agg(ratio(days, F.sum("invoice_amount"), 2).alias("dso_days"))
        .orderBy("year", "month")
    )


def customer_type_efficiency(accounts: DataFrame, stored: bool = False) -> DataFrame:
    settled = F.when(F.col("payment_status") != "OverDue", F.col("days_to_payment"))
    out = rollup(
        accounts.withColumn("_days", settled),
        ["customer_type"],
        {
            "customers": ("distinct", "customer_id"),
            "invoices": ("rows",),
            **_AMOUNTS,
            "outstanding_amount": ("sum", "outstanding_balance"),
            "avg_days_to_pay": ("avg", "_days"),
        },
        apart=stored,
    )
    return out.withColumns(
        {
            "collection_efficiency_pct": _efficiency(),
            "avg_days_to_pay": half_up(F.col("avg_days_to_pay"), 2),
            **{c: money(c) for c in ("total_billed", "total_collected", "outstanding_amount")},
        }
    ).orderBy(F.col("collection_efficiency_pct").desc_nulls_first(), "customer_type")


def with_efficiency_text(mart: DataFrame) -> DataFrame:
    """Display copy of the collection efficiency, e.g. 93.89%."""
    return mart.withColumn(
        "collection_efficiency_text", with_percent_sign(F.col("collection_efficiency_pct"))
    )
