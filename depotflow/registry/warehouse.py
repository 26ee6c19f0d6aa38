"""Storing the star tables, reading them back, and exporting."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F

from depotflow.operators.rollup import row_counts
from depotflow.plans.dimensions import dim_date
from depotflow.plans.sales_cleaning import clean_sales
from depotflow.plans.warehouse import export_list, marts, register_views, store_star
from depotflow.registry.base import query
from depotflow.registry.cleaning import _SALES, _SALES_SQL
from depotflow.registry.kpis import FY_BASE, FY_CURRENT, YEARS
from depotflow.registry.sqltext import (
    ACCOUNTS,
    CLEAN_SALES,
    PRODUCTION,
    SALES,
    STOCK,
    big,
    dbl,
    iso,
    with_,
)
from depotflow.session import shared_dir
from depotflow.operators.timeline import day_spine
from depotflow.sources.files import export_all, read_raw, read_typed, restore_dates, write_csv
from depotflow.sources.order_tables import SALES_RULES, OrderTables


def _folder(t: OrderTables) -> str:
    return f"{shared_dir(t.spark)}/depotflow-{uuid.uuid4().hex}"


def star_tables(t: OrderTables) -> dict:
    """All four cleaned facts and four dimensions."""
    return {
        "fact_sales": clean_sales(t.raw_sales(), t.RAW_SALES_ORDER, SALES_RULES),
        "fact_production": t.fact_production(),
        "fact_inventory": t.fact_inventory(),
        "fact_accounts": t.fact_accounts(),
        "dim_date": dim_date(day_spine(t.table("orders"), "o_orderdate")),
        "dim_product": t.dim_product,
        "dim_route": t.dim_route,
        "dim_customer": t.dim_customer,
    }


def stored_star(t: OrderTables, folder: str) -> dict:
    """The star's tables, stored in ``folder``.

    The joins leave a sale's lines with their invoice and invoices with their customer.  Copies are removed there
    and the cleaned rows stored without being shuffled once more; ids that lie apart are settled afterwards.
    """
    tables = star_tables(t) | {
        "fact_sales": clean_sales(t.raw_sales(), t.RAW_SALES_ORDER, SALES_RULES, within=["invoice_number"]),
        "fact_accounts": t.fact_accounts(within=["customer_id"]),
    }
    unsettled = {"fact_sales": ("sale_id", t.RAW_SALES_ORDER), "fact_accounts": ("transaction_id", ["invoice_number"])}
    return store_star(t.spark, tables, folder, unsettled)[0]


_COUNTS = {
    "fact_sales": "(SELECT count(*) FROM cleaned)",
    "fact_production": "(SELECT count(*) FROM production)",
    "fact_inventory": "(SELECT count(*) FROM stock)",
    "fact_accounts": "(SELECT count(*) FROM accounts)",
    "dim_date": "(SELECT date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) + 1 FROM orders)",
    "dim_product": "(SELECT count(*) FROM part)",
    "dim_route": "(SELECT count(*) FROM nation)",
    "dim_customer": "(SELECT count(*) FROM customer)",
}
_STAR = (CLEAN_SALES, PRODUCTION, STOCK, ACCOUNTS)


@query(
    "star_load_report",
    with_(
        *_STAR,
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, {c} AS expected_rows, {c} AS loaded_rows, true AS verified"
            for n, c in _COUNTS.items()
        ),
    ),
)
def _(t):
    return store_star(t.spark, star_tables(t), _folder(t))[1]


@query(
    "star_table_row_counts",
    with_(
        *_STAR,
        " UNION ALL ".join(f"SELECT '{n}' AS table_name, {c} AS rows" for n, c in _COUNTS.items()),
    ),
)
def _(t):
    return row_counts(star_tables(t), "table_name")


_MONTHS = "(SELECT count(DISTINCT (year, month)) FROM {0})"
_VIEW_COUNTS = {
    "vw_sales_monthly": _MONTHS.format("cleaned"),
    "vw_yoy_revenue": f"""(SELECT count(*) FROM (SELECT month FROM cleaned WHERE financial_year IN ('{FY_BASE}', '{FY_CURRENT}')
        GROUP BY 1 HAVING count(DISTINCT financial_year) = 2))""",
    "vw_customer_segments": "(SELECT count(DISTINCT (customer_id, route_name)) FROM cleaned)",
    "vw_production_monthly": _MONTHS.format("production"),
    "vw_category_efficiency": "(SELECT count(DISTINCT (year, category)) FROM production)",
    "vw_production_yoy_yield": "(SELECT count(DISTINCT category) FROM production)",
    "vw_shift_performance": "(SELECT count(DISTINCT shift) FROM production)",
    "vw_stockout_frequency": "(SELECT count(DISTINCT product_id) FROM stock)",
    "vw_monthly_turnover": "(SELECT count(DISTINCT (year, month, product_id)) FROM stock)",
    "vw_stock_supply_risk": "(SELECT count(*) FROM stock WHERE date = (SELECT max(date) FROM stock))",
    "vw_billing_collections": _MONTHS.format("accounts"),
    "vw_receivables_aging": "(SELECT count(DISTINCT aging_bucket) FROM accounts WHERE payment_status = 'OverDue')",
    "vw_customer_payment": "(SELECT count(DISTINCT customer_id) FROM accounts)",
    "vw_dso_monthly": _MONTHS.format("accounts"),
    "vw_custtype_efficiency": "(SELECT count(DISTINCT customer_type) FROM accounts)",
}


@query(
    "view_row_counts",
    with_(
        *_STAR,
        " UNION ALL ".join(f"SELECT '{n}' AS view_name, {c} AS rows" for n, c in _VIEW_COUNTS.items()),
    ),
)
def _(t):
    star, _report = store_star(t.spark, star_tables(t), _folder(t))
    views = marts(star, FY_BASE, FY_CURRENT, YEARS)
    return row_counts({name: build() for name, build in views.items()}, "view_name")


# Everything that is exported, with its number of columns.
_EXPORTS = (
    ("fact_sales", 27), ("fact_production", 20), ("fact_inventory", 20), ("fact_accounts", 23), ("dim_date", 12),
    ("dim_product", 6), ("dim_route", 3), ("dim_customer", 6), ("vw_sales_monthly", 15), ("vw_yoy_revenue", 6),
    ("vw_customer_segments", 10), ("vw_production_monthly", 13), ("vw_category_efficiency", 9),
    ("vw_production_yoy_yield", 6), ("vw_shift_performance", 6), ("vw_stockout_frequency", 8),
    ("vw_monthly_turnover", 11), ("vw_stock_supply_risk", 10), ("vw_billing_collections", 10),
    ("vw_receivables_aging", 6), ("vw_customer_payment", 12), ("vw_dso_monthly", 4), ("vw_custtype_efficiency", 8),
)


@query(
    "sql_views",
    with_(
        SALES,
        f"""SELECT year, month, count(DISTINCT invoice_number) AS invoices, {dbl('SUM(net_amount)')} AS revenue
        FROM sales GROUP BY 1, 2""",
    ),
)
def _(t):
    """The named views from SQL."""
    facts = {
        "fact_sales": t.fact_sales(customer=True, route=True, product=True),
        "fact_production": t.fact_production(),
        "fact_inventory": t.fact_inventory(),
        "fact_accounts": t.fact_accounts(),
    }
    register_views(marts(facts, FY_BASE, FY_CURRENT, YEARS))
    return t.spark.sql(
        "SELECT year, month, total_invoices AS invoices, net_revenue AS revenue FROM vw_sales_monthly"
    )


@query(
    "customers_from_typed_csv",
    f"""SELECT c_custkey AS customer_id, c_name AS customer_name, {big('c_nationkey')} AS route_id,
      {dbl('CAST(c_acctbal AS DECIMAL(18,2))')} AS credit_limit FROM customer""",
)
def _(t):
    """Customer master data written as CSV and read with declared types."""
    path = f"{_folder(t)}/customers"
    columns = ("customer_id", "customer_name", "route_id", "credit_limit")
    write_csv(t.dim_customer.select(*columns), path)
    schema = "customer_id bigint, customer_name string, route_id bigint, credit_limit decimal(18,2)"
    return read_typed(t.spark, path, schema)


def _lakhs(amount: Column) -> Column:
    """1,23,45,678.90: the last three digits of the whole part, then pairs."""
    text = amount.cast("decimal(18,2)").cast("string")
    whole = F.regexp_replace(F.substring_index(text, ".", 1), r"(\d)(?=(\d\d)+\d$)", "$1,")
    return F.concat(whole, F.lit("."), F.substring_index(text, ".", -1))


@query(
    "customers_from_indian_csv",
    f"""SELECT c_custkey AS customer_id, {dbl('CAST(c_acctbal AS DECIMAL(18,2)) * 1000')} AS credit_limit,
      {dbl('CAST(c_acctbal AS DECIMAL(18,2)) * 1000')} AS credit_limit_real,
      strftime(DATE '2024-01-31' + CAST(c_custkey % 300 AS INTEGER), '%Y-%m-%d') AS since FROM customer""",
)
def _(t):
    """Amounts with lakh grouping and dates with month names, declared as en-IN."""
    path = f"{_folder(t)}/customers_in"
    limit = F.col("credit_limit") * 1000
    since = F.date_add(F.lit("2024-01-31").cast("date"), (F.col("customer_id") % 300).cast("int"))
    out = t.dim_customer.select(
        "customer_id", _lakhs(limit).alias("credit_limit"), _lakhs(limit).alias("credit_limit_real"),
        F.date_format(since, "dd-MM-yyyy").alias("since"),
    )
    write_csv(out, path)
    schema = "customer_id bigint, credit_limit decimal(18,2), credit_limit_real double, since date"
    return read_typed(t.spark, path, schema, locale="en-IN", date_format="dd-MM-yyyy")


@query(
    "export_manifest",
    "SELECT name, 'exported' AS status, CAST(columns AS BIGINT) AS columns, CAST(NULL AS VARCHAR) AS message FROM (VALUES "
    + ", ".join(f"('{name}', {n})" for name, n in _EXPORTS)
    + ") AS e(name, columns)",
)
def _(t):
    folder = _folder(t)
    star = stored_star(t, f"{folder}/star")
    views = marts(star, FY_BASE, FY_CURRENT, YEARS, stored=True)
    return export_all(t.spark, export_list(star, views), f"{folder}/export", compression="gzip")


@query("clean_sales_from_csv", with_(CLEAN_SALES, f"SELECT {_SALES_SQL} FROM cleaned"))
def _(t):
    """Raw export as CSV files, scanned as text, cleaned."""
    path = f"{_folder(t)}/raw_sales"
    write_csv(t.raw_sales(), path, "gzip")  # read with line breaks inside values, parts are not split anyway
    raw = read_raw(t.spark, path, multi_line=True)
    keys = ("customer_id", "route_id", "product_id", "invoice_number", "year", "month")
    typed = raw.withColumns({k: raw[k].cast("bigint") for k in keys})
    return clean_sales(typed, t.RAW_SALES_ORDER, SALES_RULES).select(*_SALES)


@query(
    "accounts_csv_round_trip",
    with_(
        ACCOUNTS,
        f"""SELECT {big('invoice_number')} AS invoice_number, {iso('invoice_date')} AS invoice_date,
          {iso('due_date')} AS due_date, {iso('payment_date')} AS payment_date,
          {dbl('outstanding_balance')} AS outstanding_balance FROM accounts""",
    ),
)
def _(t):
    """Cleaned invoices written as CSV and read back with their dates restored."""
    path = f"{_folder(t)}/accounts"
    write_csv(t.fact_accounts(), path)
    rows = restore_dates(read_raw(t.spark, path), ["invoice_date", "due_date", "payment_date"])
    return rows.select(
        rows.invoice_number.cast("bigint").alias("invoice_number"),
        "invoice_date", "due_date", "payment_date",
        rows.outstanding_balance.cast("decimal(18,4)").alias("outstanding_balance"),
    )
