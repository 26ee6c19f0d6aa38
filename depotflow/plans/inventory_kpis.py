"""Stock KPI marts over ``fact_inventory``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.numeric import half_up, ladder, percent, ratio
from depotflow.operators.latest import on_last_date
from depotflow.operators.share import share_fraction

PRODUCT = ["product_id", "product_name", "category"]

# Threshold ladders.
STOCKOUT_RISK = ((5, "High Risk"), (2, "Medium Risk"), (1, "Low Risk"))
MOVEMENT = ((10, "Fast Moving"), (5, "Normal"), (1, "Slow Moving"))


def stockout_risk(days: Column) -> Column:
    return ladder(days, STOCKOUT_RISK, "No Stockout")


def movement_class(turnover: Column) -> Column:
    return ladder(turnover, MOVEMENT, "Dead Stock Risk")


def current_stock(stock: DataFrame) -> DataFrame:
    """Stock rows of the last date."""
    return (
        on_last_date(stock)
        .select(
            "date", *PRODUCT, "closing_stock", "reorder_level", "stock_status",
            "shelf_life_risk", F.round("days_of_stock", 1).alias("days_of_stock"),
        )
        .orderBy("stock_status", "category", "product_id")
    )


def stockout_frequency(stock: DataFrame) -> DataFrame:
    out = stock.groupBy(*PRODUCT).agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if(F.col("stock_status") == "Stockout").alias("stockout_days"),
        F.count_if(F.col("stock_status") == "Critical").alias("critical_days"),
    )
    return out.withColumns(
        {
            "stockout_rate_pct": percent(F.col("stockout_days"), F.col("total_days")),
            "risk_category": stockout_risk(F.col("stockout_days")),
        }
    ).orderBy(F.col("stockout_rate_pct").desc(), "product_id")


def monthly_turnover(stock: DataFrame) -> DataFrame:
    """Dispatched quantity over average stock, per product and month.

    ``turnover_ratio`` halves each row's stock as a whole number, the way integer
    columns divide; nothing else cuts a fraction.
    """
    both = F.col("opening_stock") + F.col("closing_stock")
    rows = stock.withColumns({"_both": both, "_half": F.expr("(cast(opening_stock + closing_stock as bigint)) div 2")})
    out = rows.groupBy("year", "month", "month_name", *PRODUCT).agg(
        F.sum("_both").alias("_sum_both"),
        F.sum("_half").alias("_sum_half"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("dispatched_qty").alias("total_dispatched"),
    )
    rows_n = F.col("_rows").cast("double")
    mean_half = F.col("_sum_half").cast("double") / rows_n
    mean_both = F.col("_sum_both").cast("double") / (rows_n * 2)
    out = out.withColumns(
        {
            "avg_inventory": half_up(mean_both, 2),
            "turnover_ratio": ratio(F.col("total_dispatched"), mean_half, 2),
            "turnover_ratio_exact": ratio(F.col("total_dispatched"), mean_both, 2),
        }
    ).drop("_sum_both", "_sum_half", "_rows")
    return out.withColumn("movement_category", movement_class(F.col("turnover_ratio"))).orderBy(
        "year", "month", F.col("turnover_ratio").desc_nulls_first(), "product_id"
    )


def shelf_life_risk_share(stock: DataFrame) -> DataFrame:
    """Rows per category and risk with their fraction of the category."""
    out = stock.groupBy("category", "shelf_life_risk").agg(F.count(F.lit(1)).alias("records"))
    return out.withColumn("pct", share_fraction("records", ["category"])).orderBy(
        "category", F.col("shelf_life_risk").desc()
    )


def supply_risk(closing: Column, days: Column, shelf: Column) -> Column:
    return (
        F.when(closing == 0, "Stockout")
        .when(days < 1, "Critical - Under 1 Day")
        .when(days > shelf, "At Risk - Expires Before Sold")
        .otherwise("Safe - Sells Before Expiry")
    )


def days_of_supply(stock: DataFrame) -> DataFrame:
    """Last-date stock against the average daily dispatch of the whole period."""
    now = on_last_date(stock).select(
        *PRODUCT, "closing_stock", "reorder_level", "stock_status", "shelf_life_days"
    )
    pace = stock.groupBy("product_id").agg(
        ratio(F.sum("dispatched_qty"), F.count("dispatched_qty"), 2).alias("avg_daily_dispatch")
    )
    days = ratio(F.col("closing_stock"), F.col("avg_daily_dispatch"), 2)
    out = now.join(pace, "product_id").withColumn("days_of_stock_remaining", days)
    risk = supply_risk(
        F.col("closing_stock"), F.col("days_of_stock_remaining"), F.col("shelf_life_days")
    )
    return out.withColumn("supply_risk", risk).orderBy(
        F.col("days_of_stock_remaining").desc_nulls_first(), "product_id"
    )
