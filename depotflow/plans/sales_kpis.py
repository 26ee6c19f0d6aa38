"""Sales KPI marts over ``fact_sales``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.calendar import in_financial_years
from depotflow.functions.numeric import half_up, ladder, percent, ratio
from depotflow.functions.text import with_percent_sign
from depotflow.operators.joins import with_dimension
from depotflow.operators.ranking import top_rows
from depotflow.operators.rollup import rollup
from depotflow.operators.share import share_percent
from depotflow.operators.timeline import growth, previous_period

MONTH = ["year", "month", "month_name", "quarter", "financial_year"]
CUSTOMER = ["customer_id", "customer_name", "customer_type"]

# (table, key) of a dimension that supplies attributes the sales rows do not carry.
Dimension = tuple[DataFrame, str]

# Spend tiers (the lowest label is kept as published although the tier
# reaches up to the next threshold).
TIERS = (
    (900_000, "Platinum (>=9L)"),
    (850_000, "Gold (8.5L-9L)"),
    (750_000, "Silver (7.5L-8.5L)"),
    (650_000, "Bronze (6.5L-7.5L)"),
)
TIER_REST = "Standard (<6L)"


def money(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 2).cast("decimal(38,2)")


def monthly_sales(sales: DataFrame, bitmaps: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """Monthly revenue trend with the change against the month before.

    ``bitmaps``: a stored mart of customers and invoices that has the month among its keys.  ``stored``: the
    sales are a stored table, cheap to read several times.
    """
    monthly = rollup(
        sales,
        MONTH,
        {
            "total_invoices": ("distinct", "invoice_number"),
            "unique_customers": ("distinct", "customer_id"),
            "total_qty_sold": ("sum", "quantity"),
            "gross_revenue": ("sum", "gross_amount"),
            "total_discount": ("sum", "discount"),
            "net_revenue": ("sum", "net_amount"),
        },
        bitmaps=bitmaps,
        apart=stored,
    )
    monthly = monthly.withColumns(
        {
            "avg_invoice_value": ratio(F.col("net_revenue"), F.col("total_invoices"), 2),
            "discount_pct": percent(F.col("total_discount"), F.col("gross_revenue")),
            **{c: money(c) for c in ("gross_revenue", "total_discount", "net_revenue")},
        }
    )
    monthly = previous_period(monthly, "net_revenue", ["year", "month"], "prev_month_revenue")
    change = growth(F.col("net_revenue"), F.col("prev_month_revenue"))
    return monthly.withColumn("mom_growth_pct", change).orderBy("year", "month")


def category_revenue(sales: DataFrame, products: Dimension | None = None) -> DataFrame:
    """Revenue by category; the discount figure averages per-line rates on purpose."""
    rate = (F.col("discount").cast("double") / F.nullif(F.col("gross_amount").cast("double"), F.lit(0.0)))
    lines = sales.withColumn("_rate", rate.cast("decimal(18,8)"))
    out = rollup(
        lines,
        ["category"],
        {
            "transactions": ("rows",),
            "total_qty": ("sum", "quantity"),
            "net_revenue": ("sum", "net_amount"),
            "avg_unit_price": ("avg", "unit_price"),
            "avg_discount_pct": ("avg", "_rate"),
        },
        products,
    )
    return out.withColumns(
        {
            "revenue_share_pct": share_percent("net_revenue"),
            "avg_unit_price": half_up(F.col("avg_unit_price"), 2),
            "avg_discount_pct": half_up(F.col("avg_discount_pct") * 100, 2),
            "net_revenue": money("net_revenue"),
        }
    ).orderBy(F.col("net_revenue").desc(), "category")


def route_performance(
    sales: DataFrame, customers: Dimension | None = None, bitmaps: DataFrame | None = None
) -> DataFrame:
    """Customers, invoices and revenue per delivery route; the average is per line.

    ``bitmaps``: a stored mart of customers and invoices that has the route among its keys.
    """
    out = rollup(
        sales,
        ["route_id", "route_name"],
        {
            "customers_served": ("distinct", "customer_id"),
            "total_invoices": ("distinct", "invoice_number"),
            "net_revenue": ("sum", "net_amount"),
            "avg_invoice_value": ("avg", "net_amount"),
        },
        customers,
        bitmaps,
    )
    return out.withColumns(
        {
            "revenue_per_customer": ratio(F.col("net_revenue"), F.col("customers_served"), 2),
            "avg_invoice_value": half_up(F.col("avg_invoice_value"), 2),
            "revenue_share_pct": share_percent("net_revenue"),
            "net_revenue": money("net_revenue"),
        }
    ).orderBy(F.col("net_revenue").desc(), "route_id")


def top_customers(
    sales: DataFrame, n: int = 20, customers: Dimension | None = None
) -> DataFrame:
    """The ``n`` customers with the highest lifetime revenue.

    With a customer dimension, only the ``n`` winners are looked up in it.
    """
    keys = [*CUSTOMER, "route_name"] if customers is None else ["customer_id"]
    out = rollup(
        sales,
        keys,
        {
            "total_invoices": ("distinct", "invoice_number"),
            "lifetime_revenue": ("sum", "net_amount"),
            "avg_invoice_value": ("avg", "net_amount"),
            "first_purchase": ("min", "date"),
            "last_purchase": ("max", "date"),
            "active_days": ("distinct", "date"),
        },
    )
    best = top_rows(out, "lifetime_revenue", n, "customer_id")
    if customers is not None:
        best = with_dimension(best, *customers, ["customer_name", "customer_type", "route_name"])
    return best.withColumns(
        {
            "avg_invoice_value": half_up(F.col("avg_invoice_value"), 2),
            "lifetime_revenue": money("lifetime_revenue"),
        }
    ).orderBy(F.col("lifetime_revenue").desc(), "customer_id")


def payment_modes(sales: DataFrame) -> DataFrame:
    """Mix of payment modes, shares also as display text."""
    out = rollup(
        sales,
        ["payment_mode"],
        {
            "transactions": ("rows",),
            "total_revenue": ("sum", "net_amount"),
            "avg_transaction_value": ("avg", "net_amount"),
        },
    )
    out = out.withColumns(
        {
            "txn_share": share_percent("transactions"),
            "revenue_share": share_percent("total_revenue"),
            "avg_transaction_value": half_up(F.col("avg_transaction_value"), 2),
            "total_revenue": money("total_revenue"),
        }
    )
    return out.withColumns(
        {
            "txn_share_pct": with_percent_sign(F.col("txn_share")),
            "revenue_share_pct": with_percent_sign(F.col("revenue_share")),
        }
    ).orderBy(F.col("total_revenue").desc(), "payment_mode")


def year_over_year(
    sales: DataFrame, base: str = "FY2023-24", current: str = "FY2024-25", scale: int = 2
) -> DataFrame:
    """Month-by-month comparison of two financial years; months missing from either
    year drop out.  One conditional aggregate instead of a self-join."""
    net, fy = F.col("net_amount"), F.col("financial_year")
    monthly = (
        sales.filter(in_financial_years(F.col("date"), [base, current]))
        .groupBy("month", "month_name")
        .agg(
            money(F.sum(F.when(fy == base, net))).alias("revenue_base"),
            money(F.sum(F.when(fy == current, net))).alias("revenue_current"),
        )
        .dropna(subset=["revenue_base", "revenue_current"])
    )
    change = F.col("revenue_current") - F.col("revenue_base")
    names = {
        "revenue_base": "revenue_" + base.lower().replace("-", "_"),
        "revenue_current": "revenue_" + current.lower().replace("-", "_"),
    }
    return (
        monthly.withColumns(
            {
                "absolute_change": F.round(change, scale),
                "yoy_growth_pct": growth(F.col("revenue_current"), F.col("revenue_base")),
            }
        )
        .withColumnsRenamed(names)
        .orderBy("month")
    )


def spend_tier(revenue: Column) -> Column:
    return ladder(revenue, TIERS, TIER_REST)


def spend_tier_rank(revenue: Column) -> Column:
    rank = F.lit(len(TIERS) + 1)
    for position, (threshold, _) in reversed(list(enumerate(TIERS, start=1))):
        rank = F.when(revenue >= threshold, position).otherwise(rank)
    return rank


def customer_segments(sales: DataFrame, customers: Dimension | None = None) -> DataFrame:
    """One row per customer and route with its spend tier."""
    out = rollup(
        sales,
        [*CUSTOMER, "route_name"],
        {
            "total_invoices": ("distinct", "invoice_number"),
            "total_revenue": ("sum", "net_amount"),
            "first_purchase": ("min", "date"),
            "last_purchase": ("max", "date"),
        },
        customers,
    ).withColumn("total_revenue", money("total_revenue"))
    revenue = F.col("total_revenue")
    return out.withColumns(
        {"customer_segment": spend_tier(revenue), "segment_rank": spend_tier_rank(revenue)}
    )


def segment_summary(sales: DataFrame) -> DataFrame:
    """Customers and revenue per spend tier (tiers by customer, whatever the route)."""
    identity = [c for c in CUSTOMER if c in sales.columns]
    customers = sales.groupBy(*identity).agg(money(F.sum("net_amount")).alias("revenue"))
    out = rollup(
        customers.withColumn("customer_segment", spend_tier(F.col("revenue"))),
        ["customer_segment"],
        {
            "customer_count": ("rows",),
            "segment_revenue": ("sum", "revenue"),
            "avg_customer_revenue": ("avg", "revenue"),
        },
    )
    return out.withColumns(
        {
            "revenue_share": share_percent("segment_revenue"),
            "avg_customer_revenue": half_up(F.col("avg_customer_revenue"), 2),
            "segment_revenue": money("segment_revenue"),
        }
    ).withColumn("revenue_share_pct", with_percent_sign(F.col("revenue_share"))).orderBy(
        F.col("segment_revenue").desc(), "customer_segment"
    )
