"""The measure catalogue, evaluated under several groupings."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotflow.operators.ranking import top_rank
from depotflow.operators.slicers import slice_rows
from depotflow.plans import measures
from depotflow.registry.base import query
from depotflow.registry.sqltext import (
    ACCOUNTS,
    PRODUCTION,
    SALES,
    STOCK,
    big,
    dbl,
    div,
    fy,
    iso,
    pct,
    raw_div,
    rnd,
    steps,
    with_,
)

# Fixed values, stated again for the twins.
_COLLECTION_STATUS = (((90, '✅ Healthy'), (80, '⚠️ Watch')), '❌ At Risk')
_DSO_STATUS = (((15, '✅ Good'), (30, '⚠️ Moderate')), '❌ High')
_EFFICIENCY_STATUS = (((95, '✅ On Target'), (90, '⚠️ Below Target')), '❌ Critical')

# Sales ------------------------------------------------------------------------


def _sales_sql(keys: str) -> str:
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return with_(
        SALES,
        f"""SELECT {lead}{dbl('SUM(net_amount)')} AS total_revenue, {dbl('SUM(gross_amount)')} AS total_gross_revenue,
          {dbl('SUM(discount)')} AS total_discount, {big('SUM(quantity)')} AS total_qty_sold,
          count(DISTINCT invoice_number) AS total_invoices, count(DISTINCT customer_id) AS total_customers,
          {div('SUM(net_amount)', 'count(DISTINCT invoice_number)', 4)} AS avg_invoice_value,
          {pct('SUM(discount)', 'SUM(gross_amount)', 4)} AS discount_pct FROM sales {group}""",
    )


@query("measures_sales_total", _sales_sql(""))
def _(t):
    return measures.sales_measures(t.fact_sales(), [])


@query("measures_sales_by_year_and_mode", _sales_sql("financial_year, payment_mode"))
def _(t):
    return measures.sales_measures(t.fact_sales(), ["financial_year", "payment_mode"])


@query(
    "measures_revenue_to_date",
    with_(
        SALES,
        """
days AS (SELECT CAST(d AS DATE) AS date_key FROM (SELECT unnest(generate_series(
  (SELECT min(date) FROM sales)::TIMESTAMP, (SELECT max(date) FROM sales)::TIMESTAMP, INTERVAL 1 DAY)) AS d)),
daily AS (SELECT date_key, r AS revenue FROM days
  LEFT JOIN (SELECT date, SUM(net_amount) AS r FROM sales GROUP BY 1) ON date = date_key)""",
        f"""SELECT {iso('date_key')} AS date_key, {dbl('revenue')} AS revenue,
          {dbl("SUM(revenue) OVER (PARTITION BY date_trunc('month', date_key) ORDER BY date_key ROWS UNBOUNDED PRECEDING)")} AS revenue_mtd,
          {dbl(f"SUM(revenue) OVER (PARTITION BY {fy('date_key')} ORDER BY date_key ROWS UNBOUNDED PRECEDING)")} AS revenue_ytd
        FROM daily""",
    ),
)
def _(t):
    return measures.revenue_to_date(t.fact_sales())


@query(
    "measures_monthly_time_intelligence",
    with_(
        SALES,
        """
m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS s, SUM(net_amount) AS r FROM sales GROUP BY 1)""",
        f"""SELECT {iso('m.s')} AS month_start, {dbl('m.r')} AS revenue, {dbl('y.r')} AS revenue_smly,
          {dbl('p.r')} AS revenue_previous_month, {pct('m.r - p.r', 'p.r')} AS revenue_mom_pct,
          {pct('m.r - y.r', 'y.r')} AS revenue_yoy_pct,
          (SELECT {rnd(raw_div('SUM(w.r)', 'COUNT(w.r)'), 4)} FROM m w
             WHERE w.s > m.s - INTERVAL 3 MONTH AND w.s <= m.s) AS revenue_3m_rolling_avg
        FROM m LEFT JOIN m y ON y.s + INTERVAL 12 MONTH = m.s LEFT JOIN m p ON p.s + INTERVAL 1 MONTH = m.s""",
    ),
)
def _(t):
    return measures.monthly_time_intelligence(t.fact_sales())


@query(
    "measures_time_intelligence_with_gaps",
    with_(
        SALES,
        """
few AS (SELECT CAST(date_trunc('month', date) AS DATE) AS s, SUM(net_amount) AS r FROM sales
  WHERE category = 'PROMO' AND payment_mode = '5-LOW' AND route_name = 'NATION_3' GROUP BY 1),
m AS (SELECT CAST(g.s AS DATE) AS s, few.r FROM (
    SELECT unnest(generate_series((SELECT min(s) FROM few), (SELECT max(s) FROM few), INTERVAL 1 MONTH)) AS s) g
  LEFT JOIN few ON few.s = CAST(g.s AS DATE))""",
        f"""SELECT {iso('m.s')} AS month_start, {dbl('m.r')} AS revenue, {dbl('y.r')} AS revenue_smly,
          {dbl('p.r')} AS revenue_previous_month, {pct('m.r - p.r', 'p.r')} AS revenue_mom_pct,
          {pct('m.r - y.r', 'y.r')} AS revenue_yoy_pct,
          (SELECT {rnd(raw_div('SUM(w.r)', 'COUNT(w.r)'), 4)} FROM m w
             WHERE w.s > m.s - INTERVAL 3 MONTH AND w.s <= m.s) AS revenue_3m_rolling_avg
        FROM m LEFT JOIN m y ON y.s + INTERVAL 12 MONTH = m.s LEFT JOIN m p ON p.s + INTERVAL 1 MONTH = m.s""",
    ),
)
def _(t):
    """Three slicers at once: few sales, so months without any."""
    sales = t.fact_sales(customer=True, route=True, product=True)
    some = slice_rows(sales, category="PROMO", payment_mode="5-LOW", route_name="NATION_3")
    return measures.monthly_time_intelligence(some)


def _dense_sql(keys: str, period: str) -> str:
    """Revenue per key and period; every period between the first and the last one of a key."""
    return f"""
totals AS (SELECT {keys}, CAST(date_trunc('{period}', date) AS DATE) AS s, SUM(net_amount) AS r FROM sales GROUP BY ALL),
ends AS (SELECT {keys}, min(s)::TIMESTAMP AS lo, max(s)::TIMESTAMP AS hi FROM totals GROUP BY ALL),
spine AS (SELECT {keys}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 {period})) AS DATE) AS s FROM ends),
m AS (SELECT {keys}, s, r FROM spine LEFT JOIN totals USING ({keys}, s))"""


def _monthly_sql(keys: str) -> str:
    match = lambda other: " AND ".join(f"{other}.{k.strip()} = m.{k.strip()}" for k in keys.split(","))
    trailing = f"OVER (PARTITION BY {', '.join(f'm.{k.strip()}' for k in keys.split(','))} ORDER BY m.s RANGE BETWEEN INTERVAL 2 MONTH PRECEDING AND CURRENT ROW)"
    own = ", ".join(f"m.{k.strip()}" for k in keys.split(","))
    return with_(
        SALES,
        _dense_sql(keys, "month"),
        f"""SELECT {own}, {iso('m.s')} AS month_start, {dbl('m.r')} AS revenue, {dbl('y.r')} AS revenue_smly,
          {dbl('p.r')} AS revenue_previous_month, {pct('m.r - p.r', 'p.r')} AS revenue_mom_pct,
          {pct('m.r - y.r', 'y.r')} AS revenue_yoy_pct,
          {rnd(raw_div(f'(SUM(m.r) {trailing})', f'(COUNT(m.r) {trailing})'), 4)} AS revenue_3m_rolling_avg
        FROM m LEFT JOIN m y ON y.s + INTERVAL 12 MONTH = m.s AND {match('y')}
        LEFT JOIN m p ON p.s + INTERVAL 1 MONTH = m.s AND {match('p')}""",
    )


def _to_date_sql(keys: str) -> str:
    running = "ORDER BY s ROWS UNBOUNDED PRECEDING"
    return with_(
        SALES,
        _dense_sql(keys, "day"),
        f"""SELECT {keys}, {iso('s')} AS date_key, {dbl('r')} AS revenue,
          {dbl(f"SUM(r) OVER (PARTITION BY {keys}, date_trunc('month', s) {running})")} AS revenue_mtd,
          {dbl(f"SUM(r) OVER (PARTITION BY {keys}, {fy('s')} {running})")} AS revenue_ytd FROM m""",
    )


@query("measures_monthly_by_route_and_category", _monthly_sql("route_name, category"))
def _(t):
    sales = t.fact_sales(route=True, product=True)
    return measures.monthly_time_intelligence(sales, ["route_name", "category"])


@query("measures_monthly_by_customer", _monthly_sql("customer_id"))
def _(t):
    """Most customers have months without a sale."""
    return measures.monthly_time_intelligence(t.fact_sales(), ["customer_id"])


@query("measures_monthly_by_customer_type", _monthly_sql("customer_type"))
def _(t):
    return measures.monthly_time_intelligence(t.fact_sales(), ["customer_type"], t.customers)


@query("measures_revenue_to_date_by_route", _to_date_sql("route_name"))
def _(t):
    return measures.revenue_to_date(t.fact_sales(), ["route_name"], t.customers)


@query("measures_revenue_to_date_by_category_and_mode", _to_date_sql("category, payment_mode"))
def _(t):
    return measures.revenue_to_date(t.fact_sales(product=True), ["category", "payment_mode"])


def _rank_sql(key: str) -> str:
    return with_(
        SALES,
        f"""SELECT {key}, {dbl('r')} AS total_revenue, dense_rank() OVER (ORDER BY r DESC) AS revenue_rank
        FROM (SELECT {key}, SUM(net_amount) AS r FROM sales GROUP BY 1)""",
    )


@query("measures_customer_rank", _rank_sql("customer_id"))
def _(t):
    return measures.revenue_rank(t.fact_sales(), "customer_id")


@query("measures_customer_name_rank", _rank_sql("customer_name"))
def _(t):
    return measures.revenue_rank(t.fact_sales(), "customer_name", dimension=t.customers)


@query("measures_product_rank", _rank_sql("product_name"))
def _(t):
    return measures.revenue_rank(t.fact_sales(), "product_name", dimension=t.products)


@query("measures_route_rank", _rank_sql("route_name"))
def _(t):
    return measures.revenue_rank(t.fact_sales(), "route_name", small=True, dimension=t.customers)


@query(
    "measures_top_n_customers",
    with_(
        SALES,
        f"""SELECT customer_id, {dbl('r')} AS total_revenue, rk AS customer_rank FROM (
          SELECT *, rank() OVER (ORDER BY r DESC) AS rk FROM (SELECT customer_id, SUM(net_amount) AS r FROM sales GROUP BY 1))
        WHERE rk <= 25""",
    ),
)
def _(t):
    return measures.top_n_customers(t.fact_sales(), 25)


@query(
    "measures_top_rank_with_ties",
    with_(
        SALES,
        """SELECT customer_id, lines, rk AS line_rank FROM (
          SELECT *, rank() OVER (ORDER BY lines DESC) AS rk FROM (SELECT customer_id, count(*) AS lines FROM sales GROUP BY 1))
        WHERE rk <= 10""",
    ),
)
def _(t):
    lines = t.fact_sales().groupBy("customer_id").agg(F.count(F.lit(1)).alias("lines"))
    return top_rank(lines, "lines", 10, "line_rank").select("customer_id", "lines", "line_rank")


# Production -------------------------------------------------------------------


def _production_sql(keys: str) -> str:
    eff = pct("SUM(actual_qty)", "SUM(planned_qty)", 4)
    return with_(
        PRODUCTION,
        f"""SELECT * REPLACE (CAST(efficiency_vs_target AS DOUBLE) AS efficiency_vs_target),
          {steps('production_efficiency_pct', *_EFFICIENCY_STATUS)} AS efficiency_status
        FROM (SELECT {keys}, {dbl('SUM(planned_qty)')} AS total_planned_qty, {dbl('SUM(actual_qty)')} AS total_actual_qty,
          {dbl('SUM(wastage_qty)')} AS total_wastage_qty, {dbl('SUM(raw_milk_used_l)')} AS total_raw_milk_used_l,
          {eff} AS production_efficiency_pct, {pct('SUM(wastage_qty)', 'SUM(actual_qty)', 4)} AS wastage_rate_pct,
          {pct('SUM(net_produced_qty)', 'SUM(raw_milk_used_l)', 4)} AS yield_efficiency_pct,
          CAST(CAST({eff} AS DECIMAL(18,4)) - 95 AS DECIMAL(18,4)) AS efficiency_vs_target
        FROM production GROUP BY {keys})""",
    )


@query("measures_production_by_category", _production_sql("category"))
def _(t):
    return measures.production_measures(t.fact_production(), ["category"])


@query("measures_production_by_day", _production_sql("financial_year, day_of_week"))
def _(t):
    return measures.production_measures(t.fact_production(), ["financial_year", "day_of_week"])


# Stock ------------------------------------------------------------------------


def _stock_sql(keys: str) -> str:
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    pace = raw_div("SUM(sent)", "COUNT(*)")
    held = f"({dbl('SUM(held)')} / 2.0::DOUBLE / {dbl('COUNT(*)')})"
    return with_(
        STOCK,
        f"""
daily AS (SELECT {lead}date, SUM(closing_stock) AS closing, SUM(dispatched_qty) AS sent,
  SUM(opening_stock) + SUM(closing_stock) AS held, count(*) FILTER (WHERE stock_status = 'Stockout') AS empties
  FROM stock GROUP BY {lead}date)""",
        f"""SELECT {lead}{dbl('max_by(closing, date)')} AS current_closing_stock, {big('SUM(empties)')} AS stockout_days,
          {rnd(pace, 4)} AS avg_daily_dispatch, {div('max_by(closing, date)', pace, 4)} AS days_of_stock,
          {div('SUM(sent)', held, 4)} AS stock_turnover_ratio FROM daily {group}""",
    )


@query("measures_inventory_total", _stock_sql(""))
def _(t):
    return measures.inventory_measures(t.fact_inventory(), [])


@query("measures_inventory_by_product", _stock_sql("product_id"))
def _(t):
    return measures.inventory_measures(t.fact_inventory(), ["product_id"])


@query("measures_inventory_by_month_and_category", _stock_sql("year, month, category"))
def _(t):
    return measures.inventory_measures(t.fact_inventory(), ["year", "month", "category"])


@query(
    "guide_inventory_fields",
    with_(
        STOCK,
        f"""SELECT category, count(DISTINCT CASE WHEN stock_status = 'Stockout' THEN date END) AS stockout_days,
          {pct("count(DISTINCT CASE WHEN stock_status = 'Stockout' THEN date END)", 'count(DISTINCT date)', 4)} AS stockout_rate_pct,
          {dbl('SUM(opening_stock) + SUM(closing_stock)')} / 2 AS avg_inventory,
          {div('SUM(dispatched_qty)', f"({dbl('SUM(opening_stock) + SUM(closing_stock)')} / 2)", 4)} AS turnover_ratio
        FROM stock GROUP BY 1""",
    ),
)
def _(t):
    return measures.guide_inventory_fields(t.fact_inventory(), ["category"])


# Receivables ------------------------------------------------------------------


def _accounts_sql(keys: str) -> str:
    overdue = "lower(payment_status) = 'overdue'"
    return with_(
        ACCOUNTS,
        f"""SELECT *, {steps('collection_efficiency_pct', *_COLLECTION_STATUS)} AS collection_status,
          {steps('dso', *_DSO_STATUS, op='<=')} AS dso_status
        FROM (SELECT {keys}, {dbl('SUM(invoice_amount)')} AS total_billed, {dbl('SUM(amount_paid)')} AS total_collected,
          {dbl('SUM(outstanding_balance)')} AS total_outstanding,
          {dbl(f'SUM(outstanding_balance) FILTER (WHERE {overdue})')} AS overdue_amount,
          count(*) FILTER (WHERE {overdue}) AS overdue_invoice_count,
          {dbl("SUM(outstanding_balance) FILTER (WHERE aging_bucket = '90+ Days')")} AS overdue_90_plus,
          {div(f'SUM(days_to_payment) FILTER (WHERE NOT {overdue})', f'COUNT(days_to_payment) FILTER (WHERE NOT {overdue})', 4)} AS avg_days_to_pay,
          {pct('SUM(amount_paid)', 'SUM(invoice_amount)', 4)} AS collection_efficiency_pct,
          {rnd(f"{dbl('SUM(outstanding_balance)')} * 30.0::DOUBLE / NULLIF({dbl('SUM(invoice_amount)')}, 0)", 4)} AS dso,
          {pct(f'SUM(outstanding_balance) FILTER (WHERE {overdue})', 'SUM(invoice_amount)', 4)} AS overdue_pct
        FROM accounts GROUP BY {keys})""",
    )


@query("measures_accounts_by_type", _accounts_sql("customer_type"))
def _(t):
    return measures.accounts_measures(t.fact_accounts(), ["customer_type"])


@query("measures_accounts_by_month", _accounts_sql("year, month"))
def _(t):
    return measures.accounts_measures(t.fact_accounts(), ["year", "month"])


@query("measures_accounts_by_customer", _accounts_sql("customer_id"))
def _(t):
    return measures.accounts_measures(t.fact_accounts(), ["customer_id"])
