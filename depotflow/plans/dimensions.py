"""Calendar, literal dimensions and the denormalised star read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotflow.functions.calendar import (
    day_name,
    financial_year,
    is_weekend,
    month_name,
    quarter_label,
    season,
)
from depotflow.operators.joins import with_dimension
from depotflow.sources.files import literal_table, read_typed

# The product range.
PRODUCTS = (
    ("P01", "Milk Bulk 1L", "Milk Bulk", "Litre", "42.00", "38.00", 2),
    ("P02", "Milk Packet 500ml", "Milk Packet", "Packet", "24.00", "21.00", 3),
    ("P03", "Milk Packet 200ml", "Milk Packet", "Packet", "11.00", "9.50", 3),
    ("P04", "Paneer 200g", "Paneer", "Piece", "70.00", "58.00", 7),
    ("P05", "Paneer 500g", "Paneer", "Piece", "165.00", "138.00", 7),
    ("P06", "Curd 400g", "Curd", "Piece", "36.00", "29.00", 5),
    ("P07", "Curd 1kg", "Curd", "Piece", "82.00", "68.00", 5),
    ("P08", "Ghee 500ml", "Ghee", "Piece", "310.00", "265.00", 180),
    ("P09", "Ghee 1L", "Ghee", "Piece", "595.00", "510.00", 180),
    ("P10", "Butter 100g", "Butter", "Piece", "58.00", "48.00", 90),
    ("P11", "Butter 500g", "Butter", "Piece", "265.00", "220.00", 90),
    ("P12", "Cream 200ml", "Cream", "Piece", "75.00", "62.00", 10),
)

# The delivery routes.
ROUTES = (
    ("R01", "Sector-7 Route", "Sector-7", "Rohtak", "Haryana", True),
    ("R02", "Civil Lines Route", "Civil Lines", "Rohtak", "Haryana", True),
    ("R03", "Model Town Route", "Model Town", "Rohtak", "Haryana", True),
    ("R04", "Sadar Bazar Route", "Sadar Bazar", "Rohtak", "Haryana", True),
    ("R05", "Railway Colony Route", "Railway Colony", "Rohtak", "Haryana", True),
    ("R06", "Industrial Area Route", "Industrial Area", "Rohtak", "Haryana", True),
    ("R07", "Old City Route", "Old City", "Rohtak", "Haryana", True),
    ("R08", "Bypass Road Route", "Bypass Road", "Rohtak", "Haryana", True),
)

CUSTOMER_SCHEMA = (
    "customer_id string, customer_name string, customer_type string, route_id string, "
    "city string, state string, credit_days smallint, credit_limit decimal(10,2), "
    "is_active boolean"
)


def dim_product(spark: SparkSession) -> DataFrame:
    rows = literal_table(
        spark,
        PRODUCTS,
        "product_id string, product_name string, category string, unit string, "
        "standard_price string, cost_price string, shelf_life_days int",
    )
    return rows.withColumns(
        {
            "standard_price": F.col("standard_price").cast("decimal(8,2)"),
            "cost_price": F.col("cost_price").cast("decimal(8,2)"),
            "shelf_life_days": F.col("shelf_life_days").cast("smallint"),
            "is_active": F.lit(True),
        }
    )


def dim_route(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        ROUTES,
        "route_id string, route_name string, area string, city string, state string, "
        "is_active boolean",
    )


def dim_customer(spark: SparkSession, path: str) -> DataFrame:
    """Customer master data is data, not code: read from its own CSV."""
    return read_typed(spark, path, CUSTOMER_SCHEMA)


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes for a column of days ``date_key``."""
    day = F.col("date_key")
    month = F.month(day)
    return days.select(
        day,
        day_name(day).alias("day_of_week"),
        (F.dayofweek(day) - 1).alias("day_number"),
        F.weekofyear(day).alias("week_number"),
        month.alias("month_number"),
        month_name(day).alias("month_name"),
        quarter_label(day).alias("quarter"),
        F.year(day).alias("year"),
        financial_year(day).alias("financial_year"),
        is_weekend(day).alias("is_weekend"),
        (F.last_day(day) == day).alias("is_month_end"),
        season(month).alias("season"),
    )


def star_read(
    fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, list[str]]]
) -> DataFrame:
    """Fact left-joined to dimensions: ``{name: (dimension, key, columns)}``."""
    for dim, key, columns in dims.values():
        fact = with_dimension(fact, dim, key, columns)
    return fact
