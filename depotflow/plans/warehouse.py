"""From raw tables to stored star tables and exported marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotflow.operators.dedup import keep_first
from depotflow.plans import accounts_kpis, inventory_kpis, production_kpis, sales_kpis
from depotflow.session import FREE_SHUFFLES, with_settings
from depotflow.sources.files import JOINED_BYTES, load_report, read_table, write_table


def store_star(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    folder: str,
    unsettled: Mapping[str, tuple[str, Sequence[str]]] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Replace the stored star tables and report source against stored row counts.

    Facts are partitioned by financial year.  Returns the stored tables, so that every
    later mart reads columnar files instead of repeating the cleaning.  ``unsettled`` has the id, and the order of
    its copies, of tables that were cleaned ``within`` some columns.
    """
    paths = {name: f"{folder}/{name}" for name in tables}
    written = {}
    for name, df in tables.items():
        if name in (unsettled or {}):
            rows = write_table(df, paths[name], task_bytes=JOINED_BYTES)
            rows = settle_copies(spark, paths[name], *unsettled[name]) or rows
        else:
            rows = write_table(df, paths[name])
        written[name] = (rows, paths[name])
    report = load_report(spark, written)
    return {name: read_table(spark, path) for name, path in paths.items()}, report


def settle_copies(spark: SparkSession, path: str, key: str, order: Sequence[str]) -> int | None:
    """Keep the first row of each id of a stored table; None where every id has one row already.

    The ids alone are shuffled to find that out.  If any is there twice, the table is replaced through
    ``keep_first``.
    """
    table = read_table(spark, path)
    with with_settings(spark, FREE_SHUFFLES):
        copies = table.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").count()
    return write_table(keep_first(table, [key], order), path) if copies else None


def marts(
    star: Mapping[str, DataFrame],
    base_year: str,
    current_year: str,
    yield_years: tuple[int, ...] = production_kpis.YEARS,
    stored: bool = False,
) -> dict[str, Callable[[], DataFrame]]:
    """The fifteen named views over the star tables.

    ``stored``: these are stored tables, so a view may read one several times to shuffle less.
    """
    sales, runs = star["fact_sales"], star["fact_production"]
    stock, accounts = star["fact_inventory"], star["fact_accounts"]
    return {
        "vw_sales_monthly": lambda: sales_kpis.monthly_sales(sales, stored=stored),
        "vw_yoy_revenue": lambda: sales_kpis.year_over_year(sales, base_year, current_year),
        "vw_customer_segments": lambda: sales_kpis.customer_segments(sales),
        "vw_production_monthly": lambda: production_kpis.monthly_production(runs),
        "vw_category_efficiency": lambda: production_kpis.category_efficiency(runs),
        "vw_production_yoy_yield": lambda: production_kpis.yield_by_year(
            runs, ["category"], yield_years
        ),
        "vw_shift_performance": lambda: production_kpis.shift_performance(runs),
        "vw_stockout_frequency": lambda: inventory_kpis.stockout_frequency(stock),
        "vw_monthly_turnover": lambda: inventory_kpis.monthly_turnover(stock),
        "vw_stock_supply_risk": lambda: inventory_kpis.days_of_supply(stock),
        "vw_billing_collections": lambda: accounts_kpis.billing_collections(accounts, stored=stored),
        "vw_receivables_aging": lambda: accounts_kpis.receivables_aging(accounts, stored),
        "vw_customer_payment": lambda: accounts_kpis.customer_payment(accounts),
        "vw_dso_monthly": lambda: accounts_kpis.dso_monthly(accounts),
        "vw_custtype_efficiency": lambda: accounts_kpis.customer_type_efficiency(accounts, stored),
    }


def register_views(views: Mapping[str, Callable[[], DataFrame]]) -> None:
    """Make the views available to ``spark.sql`` under their names."""
    for name, build in views.items():
        build().createOrReplaceTempView(name)


def export_list(
    star: Mapping[str, DataFrame], views: Mapping[str, Callable[[], DataFrame]]
) -> dict[str, Callable[[], DataFrame]]:
    """Everything the CSV export writes: all star tables, then all views."""
    return {**{n: (lambda df=df: df) for n, df in star.items()}, **views}
