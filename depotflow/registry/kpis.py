"""The KPI marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from depotflow.functions.text import with_percent_sign
from depotflow.operators.bitmaps import bitmap_counts, bitmap_mart
from depotflow.plans import accounts_kpis, inventory_kpis, production_kpis, sales_kpis
from depotflow.registry.base import query
from depotflow.registry.sqltext import (
    ACCOUNTS,
    PRODUCTION,
    SALES,
    STOCK,
    big,
    dbl,
    div,
    iso,
    money,
    pct,
    percent_text,
    rnd,
    raw_div,
    steps,
    txt,
    with_,
)
from depotflow.session import stored

# Fixed values, stated again for the twins.
_TIERS = ((900000, 'Platinum (>=9L)'), (850000, 'Gold (8.5L-9L)'), (750000, 'Silver (7.5L-8.5L)'), (650000, 'Bronze (6.5L-7.5L)'))
_TIER_REST = 'Standard (<6L)'

FY_BASE, FY_CURRENT = "FY1996-97", "FY1997-98"
YEARS = (1996, 1997, 1998, 1999, 2000)
_MONTH = "year, month, month_name, quarter, financial_year"
_WHO = "customer_id, customer_name, customer_type"

# Sales ------------------------------------------------------------------------

SALES_MONTHLY = f"""
monthly AS (
  SELECT {_MONTH}, count(DISTINCT invoice_number) AS total_invoices,
    count(DISTINCT customer_id) AS unique_customers, {big('SUM(quantity)')} AS total_qty_sold,
    SUM(gross_amount) AS gross_revenue, SUM(discount) AS total_discount, SUM(net_amount) AS net_revenue
  FROM sales GROUP BY ALL
),
sales_mart AS (
  SELECT * , {div('net_revenue', 'total_invoices')} AS avg_invoice_value,
    {pct('total_discount', 'gross_revenue')} AS discount_pct,
    lag(net_revenue) OVER (ORDER BY year, month) AS prev_month_revenue,
    {pct('net_revenue - lag(net_revenue) OVER (ORDER BY year, month)', 'lag(net_revenue) OVER (ORDER BY year, month)')} AS mom_growth_pct
  FROM monthly
)"""
_MONEY_MONTH = ", ".join(
    f"{dbl(c)} AS {c}" for c in ("gross_revenue", "total_discount", "net_revenue", "prev_month_revenue")
)


def sales_monthly(t):
    return sales_kpis.monthly_sales(t.fact_sales())


@query(
    "sales_monthly",
    with_(SALES, SALES_MONTHLY, f"SELECT * REPLACE ({_MONEY_MONTH}) FROM sales_mart"),
)
def _(t):
    return sales_monthly(t)


CATEGORY = f"""
category_mart AS (
  SELECT category, count(*) AS transactions, {big('SUM(quantity)')} AS total_qty,
    {dbl('SUM(net_amount)')} AS net_revenue,
    {pct('SUM(net_amount)', 'SUM(SUM(net_amount)) OVER ()')} AS revenue_share_pct,
    {rnd(raw_div('SUM(unit_price)', 'COUNT(*)'))} AS avg_unit_price,
    {rnd(raw_div(f"SUM(CAST({raw_div('discount', 'gross_amount')} AS DECIMAL(18,8)))", 'COUNT(*)') + ' * 100')} AS avg_discount_pct
  FROM sales GROUP BY 1
)"""


def category_revenue(t):
    return sales_kpis.category_revenue(t.fact_sales(), t.products)


@query("sales_by_category", with_(SALES, CATEGORY, "SELECT * FROM category_mart"))
def _(t):
    return category_revenue(t)


_ROUTES_SQL = with_(
    SALES,
    f"""SELECT route_id, route_name, count(DISTINCT customer_id) AS customers_served,
      count(DISTINCT invoice_number) AS total_invoices, {dbl('SUM(net_amount)')} AS net_revenue,
      {div('SUM(net_amount)', 'count(DISTINCT customer_id)')} AS revenue_per_customer,
      {div('SUM(net_amount)', 'COUNT(*)')} AS avg_invoice_value,
      {pct('SUM(net_amount)', 'SUM(SUM(net_amount)) OVER ()')} AS revenue_share_pct
    FROM sales GROUP BY ALL""",
)


@query("sales_route_performance", _ROUTES_SQL)
def _(t):
    return sales_kpis.route_performance(t.fact_sales(), t.customers)


# The same marts, distinct counts from one stored mart of bitmaps per month and route.
_ROUTE = ["route_id", "route_name"]


def _sales_bitmaps(t):
    return stored(bitmap_mart(t.fact_sales(route=True), [*sales_kpis.MONTH, *_ROUTE], ["customer_id", "invoice_number"]))


@query(
    "sales_monthly_from_bitmaps",
    with_(SALES, SALES_MONTHLY, f"SELECT * REPLACE ({_MONEY_MONTH}) FROM sales_mart"),
)
def _(t):
    return sales_kpis.monthly_sales(t.fact_sales(), _sales_bitmaps(t))


@query("sales_routes_from_bitmaps", _ROUTES_SQL)
def _(t):
    return sales_kpis.route_performance(t.fact_sales(), t.customers, _sales_bitmaps(t))


# Months, quarters, years, routes and all time, each merged upwards from the same stored bitmaps.
_GRAINS = {
    "month": ["financial_year", "month_name"],
    "quarter": ["financial_year", "quarter"],
    "year": ["financial_year"],
    "route_year": ["financial_year", "route_name"],
    "all": [],
}


@query(
    "sales_distincts_by_grain",
    with_(
        SALES,
        "\nUNION ALL ".join(
            f"""SELECT '{grain}' AS grain, {'financial_year' if keys else 'CAST(NULL AS VARCHAR)'} AS financial_year,
          {keys[1] if len(keys) > 1 else 'CAST(NULL AS VARCHAR)'} AS member,
          count(DISTINCT customer_id) AS customers, count(DISTINCT invoice_number) AS invoices
        FROM sales {'GROUP BY ' + ', '.join(keys) if keys else ''}"""
            for grain, keys in _GRAINS.items()
        ),
    ),
)
def _(t):
    mart = _sales_bitmaps(t)
    names = {"customers": "customer_id", "invoices": "invoice_number"}

    def level(grain, keys):
        shown = [F.col(k) for k in keys] + [F.lit(None).cast("string")] * (2 - len(keys))
        counts = bitmap_counts(mart, keys, names)
        return counts.select(F.lit(grain).alias("grain"), shown[0].alias("financial_year"), shown[1].alias("member"), *names)

    return reduce(DataFrame.unionByName, [level(*g) for g in _GRAINS.items()])


@query(
    "sales_top_customers",
    with_(
        SALES,
        f"""SELECT {_WHO}, route_name, count(DISTINCT invoice_number) AS total_invoices,
          {dbl('SUM(net_amount)')} AS lifetime_revenue, {div('SUM(net_amount)', 'COUNT(*)')} AS avg_invoice_value,
          {iso('MIN(date)')} AS first_purchase, {iso('MAX(date)')} AS last_purchase,
          count(DISTINCT date) AS active_days
        FROM sales GROUP BY {_WHO}, route_name ORDER BY SUM(net_amount) DESC, customer_id LIMIT 20""",
    ),
)
def _(t):
    return sales_kpis.top_customers(t.fact_sales(), customers=t.customers)


@query(
    "sales_payment_modes",
    with_(
        SALES,
        f"""SELECT *, {percent_text('txn_share')} AS txn_share_pct, {percent_text('revenue_share')} AS revenue_share_pct
        FROM (SELECT payment_mode, count(*) AS transactions, {dbl('SUM(net_amount)')} AS total_revenue,
          {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS txn_share,
          {pct('SUM(net_amount)', 'SUM(SUM(net_amount)) OVER ()')} AS revenue_share,
          {div('SUM(net_amount)', 'COUNT(*)')} AS avg_transaction_value FROM sales GROUP BY 1)""",
    ),
)
def _(t):
    return sales_kpis.payment_modes(t.fact_sales())


def _yoy_sql(scale: int) -> str:
    a, b = (f"revenue_{y.lower().replace('-', '_')}" for y in (FY_BASE, FY_CURRENT))
    return with_(
        SALES,
        f"""
monthly AS (SELECT month, month_name, financial_year AS fy, SUM(net_amount) AS r FROM sales GROUP BY ALL)""",
        f"""SELECT x.month, x.month_name, {dbl('x.r')} AS {a}, {dbl('y.r')} AS {b},
          {dbl(f'round(y.r - x.r, {scale})')} AS absolute_change, {pct('y.r - x.r', 'x.r')} AS yoy_growth_pct
        FROM monthly x JOIN monthly y USING (month) WHERE x.fy = '{FY_BASE}' AND y.fy = '{FY_CURRENT}'""",
    )


@query("sales_year_over_year", _yoy_sql(2))
def _(t):
    return sales_kpis.year_over_year(t.fact_sales(), FY_BASE, FY_CURRENT)


@query("sales_year_over_year_rounded", _yoy_sql(0))
def _(t):
    out = sales_kpis.year_over_year(t.fact_sales(), FY_BASE, FY_CURRENT, scale=0)
    return out


SEGMENTS = f"""
segment_mart AS (
  SELECT *, {steps('total_revenue', _TIERS, _TIER_REST)} AS customer_segment,
    CASE WHEN total_revenue >= 900000 THEN 1 WHEN total_revenue >= 850000 THEN 2
         WHEN total_revenue >= 750000 THEN 3 WHEN total_revenue >= 650000 THEN 4 ELSE 5 END AS segment_rank
  FROM (SELECT {_WHO}, route_name, count(DISTINCT invoice_number) AS total_invoices,
          SUM(net_amount) AS total_revenue, {iso('MIN(date)')} AS first_purchase, {iso('MAX(date)')} AS last_purchase
        FROM sales GROUP BY {_WHO}, route_name)
)"""


@query(
    "sales_customer_segments",
    with_(
        SALES,
        SEGMENTS,
        f"SELECT * REPLACE ({dbl('total_revenue')} AS total_revenue, {big('segment_rank')} AS segment_rank) FROM segment_mart",
    ),
)
def _(t):
    return sales_kpis.customer_segments(t.fact_sales(), t.customers)


@query(
    "sales_segment_summary",
    with_(
        SALES,
        f"""
spend AS (SELECT {_WHO}, SUM(net_amount) AS revenue FROM sales GROUP BY {_WHO})""",
        f"""SELECT *, {percent_text('revenue_share')} AS revenue_share_pct FROM (
          SELECT {steps('revenue', _TIERS, _TIER_REST)} AS customer_segment,
            count(*) AS customer_count, {dbl('SUM(revenue)')} AS segment_revenue,
            {div('SUM(revenue)', 'COUNT(*)')} AS avg_customer_revenue,
            {pct('SUM(revenue)', 'SUM(SUM(revenue)) OVER ()')} AS revenue_share
          FROM spend GROUP BY 1)""",
    ),
)
def _(t):
    return sales_kpis.segment_summary(t.fact_sales())


# Production -------------------------------------------------------------------

_RATES = f"""{pct('SUM(actual_qty)', 'SUM(planned_qty)')} AS efficiency_pct,
    {pct('SUM(wastage_qty)', 'SUM(actual_qty)')} AS wastage_pct,
    {pct('SUM(net_produced_qty)', 'SUM(raw_milk_used_l)')} AS yield_pct"""
_PLAN = f"""{dbl('SUM(planned_qty)')} AS total_planned, {dbl('SUM(actual_qty)')} AS total_actual,
    {dbl('SUM(wastage_qty)')} AS total_wastage"""
PRODUCTION_MONTHLY = f"""
production_mart AS (
  SELECT {_MONTH}, {_PLAN}, {dbl('SUM(net_produced_qty)')} AS total_net_produced,
    {money('SUM(raw_milk_used_l)')} AS raw_milk_used_l, {_RATES}
  FROM production GROUP BY ALL
)"""


def production_monthly(t):
    return production_kpis.monthly_production(t.fact_production())


@query("production_monthly", with_(PRODUCTION, PRODUCTION_MONTHLY, "SELECT * FROM production_mart"))
def _(t):
    return production_monthly(t)


@query(
    "production_category_efficiency",
    with_(
        PRODUCTION,
        f"""SELECT year, category, {_PLAN}, {money('SUM(raw_milk_used_l)')} AS total_raw_milk_l, {_RATES}
        FROM production GROUP BY year, category""",
    ),
)
def _(t):
    return production_kpis.category_efficiency(t.fact_production())


def _pivot_sql(keys: str) -> str:
    columns = ", ".join(f"max(y) FILTER (WHERE year = {y}) AS yield_{y}" for y in YEARS)
    return with_(
        PRODUCTION,
        f"""
yearly AS (SELECT {keys}, year, {pct('SUM(net_produced_qty)', 'SUM(raw_milk_used_l)')} AS y
  FROM production GROUP BY ALL)""",
        f"SELECT {keys}, {columns} FROM yearly GROUP BY {keys}",
    )


@query("production_yield_pivot", _pivot_sql("category"))
def _(t):
    return production_kpis.yield_by_year(t.fact_production(), ["category"], YEARS)


@query("production_milk_utilisation", _pivot_sql("month, month_name"))
def _(t):
    return production_kpis.yield_by_year(t.fact_production(), ["month", "month_name"], YEARS)


@query(
    "production_efficiency_bands",
    with_(
        PRODUCTION,
        f"""SELECT *, {percent_text('run_share')} AS pct_of_runs FROM (
          SELECT efficiency_band, count(*) AS production_runs,
            {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS run_share
          FROM production WHERE efficiency_band IS NOT NULL GROUP BY 1)""",
    ),
)
def _(t):
    return production_kpis.efficiency_bands(t.fact_production())


SHIFTS = f"""
shift_mart AS (
  SELECT shift, count(*) AS production_runs, {pct('SUM(actual_qty)', 'SUM(planned_qty)')} AS avg_efficiency_pct,
    {pct('SUM(wastage_qty)', 'SUM(actual_qty)')} AS avg_wastage_pct, {dbl('SUM(actual_qty)')} AS total_produced,
    {pct('SUM(actual_qty)', 'SUM(SUM(actual_qty)) OVER ()')} AS production_share_pct
  FROM production GROUP BY 1
)"""


@query("production_shift_performance", with_(PRODUCTION, SHIFTS, "SELECT * FROM shift_mart"))
def _(t):
    return production_kpis.shift_performance(t.fact_production())


@query(
    "production_shift_percent_text",
    with_(
        PRODUCTION,
        SHIFTS,
        f"""SELECT shift, {percent_text('avg_efficiency_pct')} AS efficiency_text,
          {percent_text('production_share_pct')} AS share_text FROM shift_mart""",
    ),
)
def _(t):
    out = production_kpis.shift_performance(t.fact_production())
    return out.select(
        "shift",
        with_percent_sign(out.avg_efficiency_pct).alias("efficiency_text"),
        with_percent_sign(out.production_share_pct).alias("share_text"),
    )


@query(
    "production_evening_only_days",
    with_(
        PRODUCTION,
        f"""SELECT production_id, {iso('date')} AS date, category, shift, {dbl('actual_qty')} AS actual_qty
        FROM production WHERE date NOT IN (SELECT date FROM production WHERE shift = 'Morning')""",
    ),
)
def _(t):
    out = production_kpis.runs_on_days_with_only(t.fact_production(), "Evening", "Morning")
    return out.select("production_id", "date", "category", "shift", "actual_qty")


# Stock ------------------------------------------------------------------------

_LAST = "date = (SELECT max(date) FROM stock)"


@query(
    "inventory_current_stock",
    with_(
        STOCK,
        f"""SELECT {iso('date')} AS date, product_id, product_name, category, {dbl('closing_stock')} AS closing_stock,
          {dbl('reorder_level')} AS reorder_level, stock_status, shelf_life_risk,
          {dbl('round(days_of_stock, 1)')} AS days_of_stock FROM stock WHERE {_LAST}""",
    ),
)
def _(t):
    return inventory_kpis.current_stock(t.fact_inventory())


STOCKOUTS = f"""
stockout_mart AS (
  SELECT *, {steps('stockout_days', inventory_kpis.STOCKOUT_RISK, 'No Stockout')} AS risk_category
  FROM (SELECT product_id, product_name, category, count(*) AS total_days,
          count(*) FILTER (WHERE stock_status = 'Stockout') AS stockout_days,
          count(*) FILTER (WHERE stock_status = 'Critical') AS critical_days,
          {pct("count(*) FILTER (WHERE stock_status = 'Stockout')", 'COUNT(*)')} AS stockout_rate_pct
        FROM stock GROUP BY 1, 2, 3)
)"""


def stockout_frequency(t):
    return inventory_kpis.stockout_frequency(t.fact_inventory())


@query("inventory_stockout_frequency", with_(STOCK, STOCKOUTS, "SELECT * FROM stockout_mart"))
def _(t):
    return stockout_frequency(t)


TURNOVER = f"""
turnover_mart AS (
  SELECT *, {steps('turnover_ratio', inventory_kpis.MOVEMENT, 'Dead Stock Risk')} AS movement_category
  FROM (SELECT year, month, month_name, product_id, product_name, category,
          {rnd(raw_div('SUM(held)', 'COUNT(*)') + ' / 2.0')} AS avg_inventory,
          {dbl('SUM(dispatched_qty)')} AS total_dispatched,
          {div('SUM(dispatched_qty)', raw_div('SUM(held // 2)', 'COUNT(*)'))} AS turnover_ratio,
          {div('SUM(dispatched_qty)', '(' + raw_div('SUM(held)', 'COUNT(*)') + ' / 2.0)')} AS turnover_ratio_exact
        FROM (SELECT *, CAST(opening_stock + closing_stock AS BIGINT) AS held FROM stock) GROUP BY ALL)
)"""


def monthly_turnover(t):
    return inventory_kpis.monthly_turnover(t.fact_inventory())


@query("inventory_monthly_turnover", with_(STOCK, TURNOVER, "SELECT * FROM turnover_mart"))
def _(t):
    return monthly_turnover(t)


@query(
    "inventory_shelf_life_risk",
    with_(
        STOCK,
        f"""SELECT category, shelf_life_risk, count(*) AS records,
          {div('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY category)')} AS pct
        FROM stock GROUP BY 1, 2""",
    ),
)
def _(t):
    return inventory_kpis.shelf_life_risk_share(t.fact_inventory())


SUPPLY = f"""
supply_mart AS (
  SELECT *, CASE WHEN closing_stock = 0 THEN 'Stockout' WHEN days_of_stock_remaining < 1 THEN 'Critical - Under 1 Day'
      WHEN days_of_stock_remaining > shelf_life_days THEN 'At Risk - Expires Before Sold'
      ELSE 'Safe - Sells Before Expiry' END AS supply_risk
  FROM (SELECT product_id, product_name, category, {dbl('closing_stock')} AS closing_stock,
          {dbl('reorder_level')} AS reorder_level, stock_status, {big('shelf_life_days')} AS shelf_life_days,
          avg_daily_dispatch, {div('closing_stock', 'avg_daily_dispatch')} AS days_of_stock_remaining
        FROM stock JOIN (SELECT product_id, {div('SUM(dispatched_qty)', 'COUNT(*)')} AS avg_daily_dispatch
                         FROM stock GROUP BY 1) USING (product_id)
        WHERE {_LAST})
)"""


def days_of_supply(t):
    return inventory_kpis.days_of_supply(t.fact_inventory())


@query("inventory_days_of_supply", with_(STOCK, SUPPLY, "SELECT * FROM supply_mart"))
def _(t):
    return days_of_supply(t)


# Receivables ------------------------------------------------------------------

_BILLED = f"""{dbl('SUM(invoice_amount)')} AS total_billed, {dbl('SUM(amount_paid)')} AS total_collected"""
_EFF = pct("SUM(amount_paid)", "SUM(invoice_amount)")
BILLING = f"""
billing_mart AS (
  SELECT {_MONTH}, count(DISTINCT customer_id) AS customers_billed, {_BILLED},
    {dbl('SUM(outstanding_balance)')} AS total_outstanding, {_EFF} AS collection_efficiency_pct
  FROM accounts GROUP BY ALL
)"""


def billing_collections(t):
    return accounts_kpis.billing_collections(t.fact_accounts())


@query("accounts_billing_collections", with_(ACCOUNTS, BILLING, "SELECT * FROM billing_mart"))
def _(t):
    return billing_collections(t)


@query("accounts_billing_from_bitmaps", with_(ACCOUNTS, BILLING, "SELECT * FROM billing_mart"))
def _(t):
    accounts = t.fact_accounts()
    mart = stored(bitmap_mart(accounts, accounts_kpis.MONTH, ["customer_id"]))
    return accounts_kpis.billing_collections(accounts, mart)


@query(
    "accounts_billing_percent_text",
    with_(
        ACCOUNTS,
        BILLING,
        f"""SELECT year, month, {percent_text('collection_efficiency_pct')} AS collection_efficiency_text
        FROM billing_mart""",
    ),
)
def _(t):
    out = accounts_kpis.with_efficiency_text(billing_collections(t))
    return out.select("year", "month", "collection_efficiency_text")


AGING = f"""
aging_mart AS (
  SELECT aging_bucket, count(*) AS invoices, count(DISTINCT customer_id) AS customers,
    {dbl('SUM(outstanding_balance)')} AS outstanding_amount,
    {pct('SUM(outstanding_balance)', 'SUM(SUM(outstanding_balance)) OVER ()')} AS pct_of_total,
    {big("list_position(['1-30 Days', '31-60 Days', '61-90 Days', '90+ Days'], aging_bucket)")} AS sort_order
  FROM accounts WHERE payment_status = 'OverDue' GROUP BY 1
)"""


def receivables_aging(t):
    return accounts_kpis.receivables_aging(t.fact_accounts())


@query("accounts_receivables_aging", with_(ACCOUNTS, AGING, "SELECT * FROM aging_mart"))
def _(t):
    return receivables_aging(t)


PAYMENT = f"""
payment_mart AS (
  SELECT {_WHO}, count(*) AS total_invoices, {dbl('SUM(invoice_amount)')} AS total_billed,
    {dbl('SUM(amount_paid)')} AS total_paid, {dbl('SUM(outstanding_balance)')} AS outstanding_amount,
    {div('SUM(days_to_payment)', 'COUNT(days_to_payment)')} AS avg_days_to_pay,
    count(*) FILTER (WHERE payment_status = 'Paid') AS on_time_count,
    count(*) FILTER (WHERE payment_status = 'Paid Late') AS paid_late_count,
    count(*) FILTER (WHERE payment_status = 'OverDue') AS overdue_count, {_EFF} AS collection_efficiency_pct
  FROM accounts GROUP BY {_WHO}
)"""


def customer_payment(t):
    return accounts_kpis.customer_payment(t.fact_accounts())


@query("accounts_customer_payment", with_(ACCOUNTS, PAYMENT, "SELECT * FROM payment_mart"))
def _(t):
    return customer_payment(t)


DSO = f"""
dso_mart AS (
  SELECT year, month, month_name,
    {rnd(f"{dbl('SUM(outstanding_balance)')} * 30.0::DOUBLE / NULLIF({dbl('SUM(invoice_amount)')}, 0)")} AS dso_days
  FROM accounts GROUP BY ALL
)"""


def dso_monthly(t):
    return accounts_kpis.dso_monthly(t.fact_accounts())


@query("accounts_dso_monthly", with_(ACCOUNTS, DSO, "SELECT * FROM dso_mart"))
def _(t):
    return dso_monthly(t)


TYPES = f"""
type_mart AS (
  SELECT customer_type, count(DISTINCT customer_id) AS customers, count(*) AS invoices, {_BILLED},
    {dbl('SUM(outstanding_balance)')} AS outstanding_amount, {_EFF} AS collection_efficiency_pct,
    {div("SUM(days_to_payment) FILTER (WHERE payment_status <> 'OverDue')",
         "COUNT(days_to_payment) FILTER (WHERE payment_status <> 'OverDue')")} AS avg_days_to_pay
  FROM accounts GROUP BY 1
)"""


def customer_types(t):
    return accounts_kpis.customer_type_efficiency(t.fact_accounts())


@query("accounts_customer_type_efficiency", with_(ACCOUNTS, TYPES, "SELECT * FROM type_mart"))
def _(t):
    return customer_types(t)
