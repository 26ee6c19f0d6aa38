"""The data behind each dashboard worksheet, computed from the KPI marts.

Marts are small (months, categories, products, customers), except the customer mart,
which is only ever sorted with a limit or joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from depotflow.functions.calendar import period_label, period_sort
from depotflow.functions.numeric import half_up, ladder, ladder_up, percent, ratio
from depotflow.operators.joins import relate, selected_by
from depotflow.operators.latest import last_date
from depotflow.operators.ranking import top_rows
from depotflow.operators.reshape import attribute, measures_as_rows, trend_line
from depotflow.operators.share import share_percent
from depotflow.operators.timeline import last_value
from depotflow.plans.inventory_kpis import stockout_risk
from depotflow.plans.sales_kpis import MONTH, money

# Status texts and their default thresholds per card.
CARD_EFFICIENCY = ((95, "On Target"), (90, "Near Target")), "Below Target"
CARD_EFFICIENCY_ONE = ((93.5, "On Target"),), "Below Target"
CARD_COLLECTION = ((90, "On Target"),), "Below Target"
CARD_COLLECTION_FINE = ((90, "ON TARGET"), (85, "NEAR TARGET")), "BELOW TARGET"
CARD_BILLED = ((90, "ON TARGET"),), "BELOW TARGET"
CARD_DSO = ((15, "GOOD"), (30, "MODERATE")), "HIGH"
CARD_OUTSTANDING = ((5, "HEALTHY"), (15, "WATCH")), "HIGH RISK"
CARD_STOCKOUT = ((0, "Perfect"), (1, "Acceptable")), "High Risk"
CARD_TURNOVER = ((5, "Healthy"), (1, "Watch")), "Dead Stock Risk"
SHELF_STATUS = ((7, "No Risk"), (10, "Moderate Risk")), "High Risk"
PAYMENT_RISK = ((90, "LOW RISK"), (75, "MEDIUM RISK")), "HIGH RISK"
PAYMENT_ALERT = ((90, "OK"), (75, "WATCH")), "HIGH RISK"
TYPE_RISK = ((90, "Reliable (≥90%)"), (85, "Watch (85-90%)")), "High Risk (<85%)"
DSO_GOOD_LINE, DSO_WARNING_LINE, EFFICIENCY_LINE = 15, 30, 95


def mart_average(name: str, scale: int) -> Column:
    """Average line over all rows of a mart (one row per month or category), taken as a
    window so that the mart is not computed a second time."""
    everything = W.partitionBy()
    return ratio(F.sum(name).over(everything), F.count(name).over(everything), scale)


def number_text(col: Column, scale: int) -> Column:
    """Rounded number as text without trailing zeros."""
    text = half_up(col.cast("double"), scale).cast(f"decimal(30,{max(scale, 1)})").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


# Executive --------------------------------------------------------------------


def revenue_card(sales: DataFrame) -> DataFrame:
    """Total revenue, the best month's customer count and distinct invoices, from one run of ``sales``.

    Rows are folded to month, customer and invoice first; the counts of months and of all time expand the fold.
    Without rows there are no invoices, and the other two are null.
    """
    month = F.struct(*MONTH).alias("month")
    folded = sales.groupBy(month, "customer_id", "invoice_number").agg(F.sum("net_amount").alias("net"))
    levels = folded.rollup("month").agg(
        (F.grouping("month") == 1).alias("all_time"),
        F.sum("net").alias("net"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("invoice_number").alias("invoices"),
    )
    return levels.agg(
        F.sum(F.when(~F.col("all_time"), money("net"))).alias("total_revenue"),
        F.max(F.when(~F.col("all_time"), F.col("customers"))).alias("max_unique_customers"),
        F.coalesce(F.max(F.when(F.col("all_time"), F.col("invoices"))), F.lit(0)).alias("total_invoices"),
    )


def growth_card(monthly: DataFrame) -> DataFrame:
    """Month-over-month growth of the last month with arrow and sign.

    Growth of zero or more counts as positive (the workbook's colour signal has the
    comparison the wrong way round).
    """
    last = monthly.agg(last_value(monthly, "mom_growth_pct", ["year", "month"]).alias("mom"))
    mom = F.col("mom")
    arrow = F.when(mom >= 0, "▲ ").otherwise("▼ ")
    return last.select(
        mom.alias("mom_growth_pct"),
        F.concat(arrow, number_text(F.abs(mom), 1), F.lit("%")).alias("display"),
        F.when(mom >= 0, "Positive").otherwise("Negative").alias("signal"),
    )


def last_month_only(monthly: DataFrame) -> DataFrame:
    """The row of the last period."""
    period = period_sort(F.col("year"), F.col("month"))
    marked = monthly.withColumn("_last", F.max(period).over(W.partitionBy()) == period)
    return marked.filter("_last").drop("_last")


def production_card(production: DataFrame) -> DataFrame:
    out = production.agg(
        percent(F.sum("total_actual"), F.sum("total_planned"), 4).alias("efficiency_pct")
    )
    value = F.col("efficiency_pct")
    return out.withColumns(
        {
            "status": ladder(value, *CARD_EFFICIENCY),
            "bar_status": ladder(value, *CARD_EFFICIENCY_ONE),
        }
    )


def efficiency_bullet(production: DataFrame) -> DataFrame:
    """Efficiency per financial year against the target and the average line."""
    out = production.groupBy("financial_year").agg(
        percent(F.sum("total_actual"), F.sum("total_planned"), 4).alias("efficiency_pct"),
        ratio(F.sum("efficiency_pct"), F.count("efficiency_pct"), 4).alias("avg_month_efficiency"),
        half_up(F.median(F.col("efficiency_pct").cast("double")), 4).alias("median_month_efficiency"),
        F.min("efficiency_pct").alias("min_month_efficiency"),
        F.max("efficiency_pct").alias("max_month_efficiency"),
        attribute("quarter").alias("only_quarter"),
        F.sum("efficiency_pct").alias("_sum"),
        F.count("efficiency_pct").alias("_n"),
    )
    everything = W.partitionBy()
    line = ratio(F.sum("_sum").over(everything), F.sum("_n").over(everything), 4)
    out = out.withColumn("average_line", line).drop("_sum", "_n")
    return out.withColumns(
        {
            "target_line": F.lit(EFFICIENCY_LINE),
            "status": ladder(F.col("efficiency_pct"), *CARD_EFFICIENCY_ONE),
        }
    )


def stockout_card(frequency: DataFrame) -> DataFrame:
    return frequency.agg(
        ratio(F.sum("stockout_days"), F.sum("total_days"), 6).alias("stockout_rate")
    )


def stock_status_bars(frequency: DataFrame) -> DataFrame:
    return frequency.select(
        "product_id", "product_name", "stockout_days",
        stockout_risk(F.col("stockout_days")).alias("risk_level"),
    ).orderBy(F.col("stockout_days").desc(), "product_id")


def collection_card(billing: DataFrame) -> DataFrame:
    billed, collected = F.sum("total_billed"), F.sum("total_collected")
    out = billing.agg(
        ratio(collected, billed, 6).alias("collection_ratio"),
        percent(collected, billed, 4).alias("collection_pct"),
    )
    value = F.col("collection_pct")
    return out.withColumns(
        {
            "status": ladder(value, *CARD_COLLECTION),
            "fine_status": ladder(value, *CARD_COLLECTION_FINE),
            "billed_status": ladder(value, *CARD_BILLED),
        }
    )


def revenue_trend(monthly: DataFrame, growth_year: str) -> DataFrame:
    """Monthly revenue with axis label and sort key; growth only for one year."""
    year, month = F.col("year"), F.col("month")
    return monthly.select(
        period_sort(year, month).alias("month_sort"),
        period_label(F.col("month_name"), year).alias("month_label"),
        "financial_year",
        "net_revenue",
        F.when(F.col("financial_year") == growth_year, F.col("mom_growth_pct")).alias("mom_display"),
        mart_average("net_revenue", 2).alias("average_line"),
    ).orderBy("month_sort")


def category_split(categories: DataFrame) -> DataFrame:
    return categories.select(
        "category", "net_revenue", share_percent("net_revenue", scale=4).alias("revenue_share_pct")
    )


def aging_bars(aging: DataFrame) -> DataFrame:
    """Open amount per bucket in bucket order with share and two-line label."""
    out = aging.select(
        "aging_bucket", "sort_order", "outstanding_amount",
        share_percent("outstanding_amount", scale=4).alias("share_pct"),
    )
    label = F.concat(
        F.lit("₹"), number_text(F.col("outstanding_amount") / 1000, 0), F.lit("K\n"),
        number_text(F.col("share_pct"), 1), F.lit("%"),
    )
    return out.withColumn("label", label).orderBy("sort_order")


# Finance ----------------------------------------------------------------------


def billing_combo(billing: DataFrame) -> DataFrame:
    year = F.col("year")
    return billing.select(
        period_sort(year, F.col("month")).alias("period_sort"),
        period_label(F.col("month_name"), year, "").alias("period_label"),
        "total_billed", "total_collected", "collection_efficiency_pct",
        (F.col("total_billed") - F.col("total_collected")).alias("uncollected_amount"),
    ).orderBy("period_sort")


def largest_debtors(payment: DataFrame, n: int = 5, customer_type: str | None = None) -> DataFrame:
    """Top names by open amount with risk and alert.

    The customer-type filter is a context filter: it applies before the top-n.  Names
    are not unique, so customers that share a name are taken together.
    """
    rows = payment if customer_type is None else payment.filter(F.col("customer_type") == customer_type)
    out = rows.groupBy("customer_name").agg(
        F.sum("outstanding_amount").alias("outstanding_amount"),
        F.sum("total_billed").alias("total_billed"),
        F.sum("overdue_count").alias("overdue_count"),
        ratio(F.sum("collection_efficiency_pct"), F.count("collection_efficiency_pct"), 4).alias(
            "avg_efficiency"
        ),
    )
    out = top_rows(out, "outstanding_amount", n, "customer_name")
    value = F.col("avg_efficiency")
    return out.withColumns(
        {"risk_level": ladder(value, *PAYMENT_RISK), "alert": ladder(value, *PAYMENT_ALERT)}
    ).orderBy(F.col("outstanding_amount").desc(), "customer_name")


def customer_type_bars(types: DataFrame) -> DataFrame:
    return types.select(
        "customer_type", "collection_efficiency_pct", "avg_days_to_pay", "total_billed",
        share_percent("total_billed", scale=4).alias("billed_share_pct"),
        ladder(F.col("collection_efficiency_pct"), *TYPE_RISK).alias("risk"),
    ).orderBy(F.col("collection_efficiency_pct").desc(), "customer_type")


def dso_trend(dso: DataFrame) -> DataFrame:
    year = F.col("year")
    return dso.select(
        period_sort(year, F.col("month")).alias("period_sort"),
        period_label(F.col("month_name"), year).alias("period_label"),
        "dso_days",
        F.lit(DSO_GOOD_LINE).alias("good_zone"),
        F.lit(DSO_WARNING_LINE).alias("warning_zone"),
    ).orderBy("period_sort")


def finance_cards(billing: DataFrame) -> DataFrame:
    """Average monthly DSO beside the open, billed and collected totals.

    The average of monthly DSO differs from the overall ratio in ``accounts_measures``.
    """
    days = F.col("total_outstanding").cast("double") * F.lit(30.0)
    months = billing.withColumn("_dso", ratio(days, F.col("total_billed"), 2))
    out = months.agg(
        F.sum("total_billed").alias("total_billed"),
        F.sum("total_collected").alias("total_collected"),
        F.sum("total_outstanding").alias("total_outstanding"),
        percent(F.sum("total_outstanding"), F.sum("total_billed"), 4).alias("outstanding_pct"),
        ratio(F.sum("_dso"), F.count("_dso"), 4).alias("avg_dso"),
    )
    return out.withColumns(
        {
            "dso_status": ladder_up(F.col("avg_dso"), *CARD_DSO),
            "outstanding_alert": ladder_up(F.col("outstanding_pct"), *CARD_OUTSTANDING),
        }
    )


# Stock ------------------------------------------------------------------------


def current_stock_highlight(stock: DataFrame) -> DataFrame:
    """Last-date stock per category, product and status as measure rows."""
    keys = ["category", "product_name", "stock_status"]
    now = stock.filter(F.col("date") == last_date(stock))
    out = now.groupBy(*keys).agg(
        F.sum("closing_stock").alias("closing_stock"),
        ratio(F.sum("days_of_stock"), F.count("days_of_stock"), 4).alias("days_of_stock"),
        ratio(F.sum("reorder_level"), F.count("reorder_level"), 4).alias("reorder_level"),
        F.sum("shelf_life_days").alias("shelf_life_days"),
        attribute("shelf_life_risk").alias("shelf_life_risk"),
    )
    out = out.withColumns(
        {
            "reorder_alert": F.when(
                F.col("closing_stock") <= F.col("reorder_level"), "⚡ REORDER"
            ).otherwise(""),
            "risk_icon": F.when(F.col("shelf_life_risk") == "At Risk", "⚠ At Risk").otherwise("✓ Safe"),
        }
    )
    measures = ["closing_stock", "days_of_stock", "reorder_level", "shelf_life_days"]
    return measures_as_rows(out, [*keys, "reorder_alert", "risk_icon"], measures)


def supply_lollipop(supply: DataFrame) -> DataFrame:
    return supply.groupBy("product_name").agg(
        ratio(F.sum("days_of_stock_remaining"), F.count("days_of_stock_remaining"), 4).alias("days_remaining"),
        ratio(F.sum("shelf_life_days"), F.count("shelf_life_days"), 4).alias("shelf_life_line"),
    ).withColumn("shelf_life_status", ladder_up(F.col("shelf_life_line"), *SHELF_STATUS))


def at_risk_card(stock: DataFrame) -> DataFrame:
    """Products at shelf-life risk on the last date."""
    now = stock.filter(F.col("date") == last_date(stock))
    return now.filter(F.col("shelf_life_risk") == "At Risk").agg(
        F.count_distinct("product_id").alias("products_at_risk"),
        F.sum("closing_stock").alias("stock_at_risk"),
    )


def stock_cards(stock: DataFrame, turnover: DataFrame) -> DataFrame:
    """Row-based stockout rate, stock on the last date, average monthly turnover."""
    mean = turnover.agg(ratio(F.sum("turnover_ratio"), F.count("turnover_ratio"), 4)).scalar()
    daily = stock.groupBy("date").agg(
        F.sum("closing_stock").alias("_closing"),
        F.count_if(F.col("stock_status") == "Stockout").alias("_stockouts"),
        F.count("inventory_id").alias("_rows"),
    )
    out = daily.agg(
        percent(F.sum("_stockouts"), F.sum("_rows"), 4).alias("stockout_rate_pct"),
        F.max_by("_closing", "date").alias("total_stock"),
    ).withColumn("avg_turnover", mean)
    return out.withColumns(
        {
            "stockout_status": ladder_up(F.col("stockout_rate_pct"), *CARD_STOCKOUT),
            "turnover_status": ladder(F.col("avg_turnover"), *CARD_TURNOVER),
        }
    )


def _turnover_lines(turnover: DataFrame) -> DataFrame:
    return turnover.groupBy("year", "month", "month_name", "category").agg(
        ratio(F.sum("turnover_ratio"), F.count("turnover_ratio"), 4).alias("avg_turnover")
    )


def turnover_lines(turnover: DataFrame) -> DataFrame:
    """Average turnover by month and category with the table's average line."""
    out = _turnover_lines(turnover)
    year, month = F.col("year"), F.col("month")
    return out.select(
        period_sort(year, month).alias("period_sort"),
        period_label(F.col("month_name"), year).alias("period_label"),
        F.make_date(year, month, F.lit(1)).alias("month_date"),
        "category", "avg_turnover", mart_average("avg_turnover", 4).alias("average_line"),
    ).orderBy("period_sort", "category")


def turnover_trend(turnover: DataFrame) -> DataFrame:
    """Linear trend of the monthly turnover per category over the month number."""
    points = _turnover_lines(turnover).withColumn("_x", F.col("year") * 12 + F.col("month"))
    return trend_line(points, ["category"], "_x", "avg_turnover")


def stockout_bars(frequency: DataFrame) -> DataFrame:
    label = F.concat(
        number_text(F.col("stockout_rate_pct"), 2), F.lit("% ("),
        F.col("stockout_days").cast("string"), F.lit(" days)"),
    )
    return frequency.select(
        "product_id", "product_name", "stockout_rate_pct", label.alias("label"),
        stockout_risk(F.col("stockout_days")).alias("risk_level"),
    ).orderBy(F.col("stockout_rate_pct").desc(), "product_id")


def status_distribution(stock: DataFrame) -> DataFrame:
    """Distinct products per stock status on the last date."""
    now = stock.filter(F.col("date") == last_date(stock))
    return (
        now.groupBy("stock_status")
        .agg(F.count_distinct("product_id").alias("products"))
        .orderBy(F.col("products").desc(), "stock_status")
    )


# Relationships and interaction ------------------------------------------------


def sales_with_production(monthly: DataFrame, production: DataFrame) -> DataFrame:
    """Two monthly marts related on three keys; nothing fans out."""
    return relate(
        monthly.select("financial_year", "month_name", "year", "net_revenue"),
        production.select("financial_year", "month_name", "year", "total_actual", "efficiency_pct"),
        ["financial_year", "month_name", "year"],
        ["total_actual", "efficiency_pct"],
    )


def blended_share(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Blend: each source aggregated on its own, then linked by financial year."""
    left = primary.groupBy("financial_year").agg(F.sum("net_revenue").alias("revenue"))
    right = secondary.groupBy("financial_year").agg(F.sum("total_billed").alias("billed"))
    return left.join(right, "financial_year", "left").withColumn(
        "revenue_share_pct", share_percent("revenue", scale=4)
    )


def filtered_by_marks(sales: DataFrame, marks: DataFrame, on: list[str]) -> DataFrame:
    """Monthly revenue of the rows that match the marks selected on another sheet."""
    return selected_by(sales, marks, on).groupBy("year", "month").agg(
        F.sum("net_amount").alias("net_revenue")
    )
