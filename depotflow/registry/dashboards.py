"""The data behind the dashboard worksheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotflow.operators.slicers import slice_rows
from depotflow.plans import worksheets as ws
from depotflow.registry import kpis
from depotflow.registry.base import query
from depotflow.registry.kpis import (
    AGING,
    BILLING,
    DSO,
    FY_CURRENT,
    PAYMENT,
    PRODUCTION_MONTHLY,
    SALES_MONTHLY,
    STOCKOUTS,
    SUPPLY,
    TURNOVER,
    TYPES,
)
from depotflow.registry.sqltext import (
    ACCOUNTS,
    PRODUCTION,
    SALES,
    STOCK,
    big,
    dbl,
    div,
    iso,
    number_text,
    pct,
    raw_div,
    rnd,
    steps,
    with_,
)

# Fixed values, stated again for the twins.
_CARD_BILLED = (((90, 'ON TARGET'),), 'BELOW TARGET')
_CARD_COLLECTION = (((90, 'On Target'),), 'Below Target')
_CARD_COLLECTION_FINE = (((90, 'ON TARGET'), (85, 'NEAR TARGET')), 'BELOW TARGET')
_CARD_DSO = (((15, 'GOOD'), (30, 'MODERATE')), 'HIGH')
_CARD_EFFICIENCY = (((95, 'On Target'), (90, 'Near Target')), 'Below Target')
_CARD_EFFICIENCY_ONE = (((93.5, 'On Target'),), 'Below Target')
_CARD_OUTSTANDING = (((5, 'HEALTHY'), (15, 'WATCH')), 'HIGH RISK')
_CARD_STOCKOUT = (((0, 'Perfect'), (1, 'Acceptable')), 'High Risk')
_CARD_TURNOVER = (((5, 'Healthy'), (1, 'Watch')), 'Dead Stock Risk')
_PAYMENT_ALERT = (((90, 'OK'), (75, 'WATCH')), 'HIGH RISK')
_PAYMENT_RISK = (((90, 'LOW RISK'), (75, 'MEDIUM RISK')), 'HIGH RISK')
_SHELF_STATUS = (((7, 'No Risk'), (10, 'Moderate Risk')), 'High Risk')
_TYPE_RISK = (((90, 'Reliable (≥90%)'), (85, 'Watch (85-90%)')), 'High Risk (<85%)')

def _dec(x: str, scale: int = 2) -> str:
    return f"CAST({x} AS DECIMAL(38,{scale}))"


def _mean(x: str, scale: int = 4) -> str:
    """Average of a rounded mart column, summed exactly."""
    return rnd(raw_div(f"SUM({_dec(x)})", f"COUNT({x})"), scale)


def _mean_all(x: str, scale: int = 4) -> str:
    return rnd(raw_div(f"SUM({_dec(x, max(scale, 2))}) OVER ()", f"COUNT({x}) OVER ()"), scale)


_LABEL = "left(month_name, 3) || ' ' || year"

# Executive --------------------------------------------------------------------


@query(
    "card_total_revenue",
    with_(
        SALES,
        SALES_MONTHLY,
        f"""SELECT {dbl('SUM(net_revenue)')} AS total_revenue, max(unique_customers) AS max_unique_customers,
          (SELECT count(DISTINCT invoice_number) FROM sales) AS total_invoices FROM sales_mart""",
    ),
)
def _(t):
    return ws.revenue_card(t.fact_sales())


_LAST_MOM = "max_by(mom_growth_pct, year * 100 + month)"


@query(
    "card_mom_growth",
    with_(
        SALES,
        SALES_MONTHLY,
        f"""SELECT m AS mom_growth_pct,
          CASE WHEN m >= 0 THEN '▲ ' ELSE '▼ ' END || {number_text('abs(m)', 1)} || '%' AS display,
          CASE WHEN m >= 0 THEN 'Positive' ELSE 'Negative' END AS signal
        FROM (SELECT {_LAST_MOM} AS m FROM sales_mart)""",
    ),
)
def _(t):
    return ws.growth_card(kpis.sales_monthly(t))


@query(
    "last_month_row",
    with_(
        SALES,
        SALES_MONTHLY,
        f"""SELECT year, month, {dbl('net_revenue')} AS net_revenue, mom_growth_pct FROM sales_mart
        WHERE year * 100 + month = (SELECT max(year * 100 + month) FROM sales_mart)""",
    ),
)
def _(t):
    out = ws.last_month_only(kpis.sales_monthly(t))
    return out.select("year", "month", "net_revenue", "mom_growth_pct")


@query(
    "card_production_efficiency",
    with_(
        PRODUCTION,
        f"""SELECT *, {steps('efficiency_pct', *_CARD_EFFICIENCY)} AS status,
          {steps('efficiency_pct', *_CARD_EFFICIENCY_ONE)} AS bar_status
        FROM (SELECT {pct('SUM(actual_qty)', 'SUM(planned_qty)', 4)} AS efficiency_pct FROM production)""",
    ),
)
def _(t):
    return ws.production_card(kpis.production_monthly(t))


@query(
    "efficiency_bullet",
    with_(
        PRODUCTION,
        PRODUCTION_MONTHLY,
        f"""SELECT *, (SELECT {_mean('efficiency_pct')} FROM production_mart) AS average_line,
          {big('95')} AS target_line, {steps('efficiency_pct', *_CARD_EFFICIENCY_ONE)} AS status
        FROM (SELECT financial_year, {pct('SUM(total_actual)', 'SUM(total_planned)', 4)} AS efficiency_pct,
            {_mean('efficiency_pct')} AS avg_month_efficiency, {rnd('median(efficiency_pct)', 4)} AS median_month_efficiency,
            min(efficiency_pct) AS min_month_efficiency, max(efficiency_pct) AS max_month_efficiency,
            CASE WHEN min(quarter) = max(quarter) THEN min(quarter) END AS only_quarter
          FROM production_mart GROUP BY 1)""".replace(
            "SUM(total_actual)", f"SUM({_dec('total_actual', 4)})"
        ).replace("SUM(total_planned)", f"SUM({_dec('total_planned', 4)})"),
    ),
)
def _(t):
    return ws.efficiency_bullet(kpis.production_monthly(t))


@query(
    "card_stockout_rate",
    with_(STOCK, STOCKOUTS, f"SELECT {div('SUM(stockout_days)', 'SUM(total_days)', 6)} AS stockout_rate FROM stockout_mart"),
)
def _(t):
    return ws.stockout_card(kpis.stockout_frequency(t))


@query(
    "stock_status_bars",
    with_(
        STOCK,
        STOCKOUTS,
        "SELECT product_id, product_name, stockout_days, risk_category AS risk_level FROM stockout_mart",
    ),
)
def _(t):
    return ws.stock_status_bars(kpis.stockout_frequency(t))


@query(
    "card_collection_efficiency",
    with_(
        ACCOUNTS,
        f"""SELECT *, {steps('collection_pct', *_CARD_COLLECTION)} AS status,
          {steps('collection_pct', *_CARD_COLLECTION_FINE)} AS fine_status,
          {steps('collection_pct', *_CARD_BILLED)} AS billed_status
        FROM (SELECT {div('SUM(amount_paid)', 'SUM(invoice_amount)', 6)} AS collection_ratio,
          {pct('SUM(amount_paid)', 'SUM(invoice_amount)', 4)} AS collection_pct FROM accounts)""",
    ),
)
def _(t):
    return ws.collection_card(kpis.billing_collections(t))


@query(
    "revenue_trend",
    with_(
        SALES,
        SALES_MONTHLY,
        f"""SELECT {big('year * 100 + month')} AS month_sort, {_LABEL} AS month_label, financial_year,
          {dbl('net_revenue')} AS net_revenue,
          CASE WHEN financial_year = '{FY_CURRENT}' THEN mom_growth_pct END AS mom_display,
          {_mean_all('net_revenue', 2)} AS average_line FROM sales_mart""",
    ),
)
def _(t):
    return ws.revenue_trend(kpis.sales_monthly(t), FY_CURRENT)


@query(
    "category_split",
    with_(
        SALES,
        f"""SELECT category, {dbl('SUM(net_amount)')} AS net_revenue,
          {pct('SUM(net_amount)', 'SUM(SUM(net_amount)) OVER ()', 4)} AS revenue_share_pct FROM sales GROUP BY 1""",
    ),
)
def _(t):
    return ws.category_split(kpis.category_revenue(t))


_AGING_BARS = f"""
bars AS (SELECT aging_bucket, sort_order, outstanding_amount,
  {pct(_dec('outstanding_amount'), f"SUM({_dec('outstanding_amount')}) OVER ()", 4)} AS share_pct FROM aging_mart)"""


@query(
    "aging_bars",
    with_(
        ACCOUNTS,
        AGING,
        _AGING_BARS,
        f"""SELECT *, '₹' || {number_text(dbl('outstanding_amount') + ' / 1000', 0)} || E'K\\n'
          || {number_text('share_pct', 1)} || '%' AS label FROM bars""",
    ),
)
def _(t):
    return ws.aging_bars(kpis.receivables_aging(t))


# Finance ----------------------------------------------------------------------


@query(
    "billing_combo",
    with_(
        ACCOUNTS,
        BILLING,
        f"""SELECT {big('year * 100 + month')} AS period_sort, left(month_name, 3) || year AS period_label,
          total_billed, total_collected, collection_efficiency_pct,
          {dbl(_dec('total_billed') + ' - ' + _dec('total_collected'))} AS uncollected_amount FROM billing_mart""",
    ),
)
def _(t):
    return ws.billing_combo(kpis.billing_collections(t))


def _debtors_sql(where: str) -> str:
    return with_(
        ACCOUNTS,
        PAYMENT,
        f"""
ctx AS (SELECT * FROM payment_mart WHERE {where}),
top5 AS (SELECT customer_name FROM ctx GROUP BY 1 ORDER BY SUM({_dec('outstanding_amount')}) DESC, 1 LIMIT 5)""",
        f"""SELECT *, {steps('avg_efficiency', *_PAYMENT_RISK)} AS risk_level,
          {steps('avg_efficiency', *_PAYMENT_ALERT)} AS alert
        FROM (SELECT customer_name, {dbl(f"SUM({_dec('outstanding_amount')})")} AS outstanding_amount,
          {dbl(f"SUM({_dec('total_billed')})")} AS total_billed, {big('SUM(overdue_count)')} AS overdue_count,
          {_mean('collection_efficiency_pct')} AS avg_efficiency
          FROM ctx WHERE customer_name IN (SELECT customer_name FROM top5) GROUP BY 1)""",
    )


@query("largest_debtors", _debtors_sql("true"))
def _(t):
    return ws.largest_debtors(kpis.customer_payment(t))


@query("largest_debtors_in_context", _debtors_sql("customer_type = 'BUILDING'"))
def _(t):
    return ws.largest_debtors(kpis.customer_payment(t), customer_type="BUILDING")


@query(
    "customer_type_bars",
    with_(
        ACCOUNTS,
        TYPES,
        f"""SELECT customer_type, collection_efficiency_pct, avg_days_to_pay, total_billed,
          {pct(_dec('total_billed'), f"SUM({_dec('total_billed')}) OVER ()", 4)} AS billed_share_pct,
          {steps('collection_efficiency_pct', *_TYPE_RISK)} AS risk FROM type_mart""",
    ),
)
def _(t):
    return ws.customer_type_bars(kpis.customer_types(t))


@query(
    "dso_trend",
    with_(
        ACCOUNTS,
        DSO,
        f"""SELECT {big('year * 100 + month')} AS period_sort, {_LABEL} AS period_label, dso_days,
          {big('15')} AS good_zone, {big('30')} AS warning_zone FROM dso_mart""",
    ),
)
def _(t):
    return ws.dso_trend(kpis.dso_monthly(t))


@query(
    "finance_cards",
    with_(
        ACCOUNTS,
        DSO,
        f"""SELECT *, {steps('avg_dso', *_CARD_DSO, op='<=')} AS dso_status,
          {steps('outstanding_pct', *_CARD_OUTSTANDING, op='<=')} AS outstanding_alert
        FROM (SELECT {dbl('SUM(invoice_amount)')} AS total_billed, {dbl('SUM(amount_paid)')} AS total_collected,
          {dbl('SUM(outstanding_balance)')} AS total_outstanding,
          {pct('SUM(outstanding_balance)', 'SUM(invoice_amount)', 4)} AS outstanding_pct,
          (SELECT {_mean('dso_days')} FROM dso_mart) AS avg_dso FROM accounts)""",
    ),
)
def _(t):
    return ws.finance_cards(kpis.billing_collections(t))


# Stock ------------------------------------------------------------------------

_NOW = "date = (SELECT max(date) FROM stock)"
_HIGHLIGHT = f"""
now AS (SELECT category, product_name, stock_status, SUM(closing_stock) AS closing,
  {div('SUM(days_of_stock)', 'COUNT(days_of_stock)', 4)} AS cover, {div('SUM(reorder_level)', 'COUNT(reorder_level)', 4)} AS reorder,
  {big('SUM(shelf_life_days)')} AS shelf, CASE WHEN min(shelf_life_risk) = max(shelf_life_risk) THEN min(shelf_life_risk) END AS risk
  FROM stock WHERE {_NOW} GROUP BY 1, 2, 3)"""


@query(
    "current_stock_highlight",
    with_(
        STOCK,
        _HIGHLIGHT,
        f"""SELECT category, product_name, stock_status,
          CASE WHEN closing <= reorder THEN '⚡ REORDER' ELSE '' END AS reorder_alert,
          CASE WHEN risk = 'At Risk' THEN '⚠ At Risk' ELSE '✓ Safe' END AS risk_icon,
          unnest(['closing_stock', 'days_of_stock', 'reorder_level', 'shelf_life_days']) AS measure,
          unnest([{dbl('closing')}, cover, reorder, {dbl('shelf')}]) AS value FROM now""",
    ),
)
def _(t):
    return ws.current_stock_highlight(t.fact_inventory())


@query(
    "supply_lollipop",
    with_(
        STOCK,
        SUPPLY,
        f"""SELECT *, {steps('shelf_life_line', *_SHELF_STATUS, op='<=')} AS shelf_life_status
        FROM (SELECT product_name, {_mean('days_of_stock_remaining')} AS days_remaining,
          {_mean('shelf_life_days')} AS shelf_life_line FROM supply_mart GROUP BY 1)""",
    ),
)
def _(t):
    return ws.supply_lollipop(kpis.days_of_supply(t))


@query(
    "card_products_at_risk",
    with_(
        STOCK,
        f"""SELECT count(DISTINCT product_id) AS products_at_risk, {dbl('SUM(closing_stock)')} AS stock_at_risk
        FROM stock WHERE {_NOW} AND shelf_life_risk = 'At Risk'""",
    ),
)
def _(t):
    return ws.at_risk_card(t.fact_inventory())


@query(
    "card_stock",
    with_(
        STOCK,
        TURNOVER,
        f"""SELECT *, {steps('stockout_rate_pct', *_CARD_STOCKOUT, op='<=')} AS stockout_status,
          {steps('avg_turnover', *_CARD_TURNOVER)} AS turnover_status
        FROM (SELECT {pct("count(*) FILTER (WHERE stock_status = 'Stockout')", 'COUNT(*)', 4)} AS stockout_rate_pct,
          {dbl(f'SUM(closing_stock) FILTER (WHERE {_NOW})')} AS total_stock,
          (SELECT {_mean('turnover_ratio')} FROM turnover_mart) AS avg_turnover FROM stock)""",
    ),
)
def _(t):
    return ws.stock_cards(t.fact_inventory(), kpis.monthly_turnover(t))


_LINES = f"""
lines AS (SELECT year, month, month_name, category, {_mean('turnover_ratio')} AS avg_turnover
  FROM turnover_mart GROUP BY ALL)"""


@query(
    "turnover_lines",
    with_(
        STOCK,
        TURNOVER,
        _LINES,
        f"""SELECT {big('year * 100 + month')} AS period_sort, {_LABEL} AS period_label,
          {iso('make_date(year, month, 1)')} AS month_date, category, avg_turnover,
          {_mean_all('avg_turnover', 4)} AS average_line FROM lines""",
    ),
)
def _(t):
    return ws.turnover_lines(kpis.monthly_turnover(t))


@query(
    "turnover_trend",
    with_(
        STOCK,
        TURNOVER,
        _LINES,
        """SELECT category, round(regr_slope(avg_turnover, year * 12 + month), 6) AS slope,
          round(regr_intercept(avg_turnover, year * 12 + month), 3) AS intercept FROM lines GROUP BY 1""",
    ),
)
def _(t):
    out = ws.turnover_trend(kpis.monthly_turnover(t))
    return out.select(
        "category", F.round("slope", 6).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


@query(
    "stockout_bars",
    with_(
        STOCK,
        STOCKOUTS,
        f"""SELECT product_id, product_name, stockout_rate_pct,
          {number_text('stockout_rate_pct', 2)} || '% (' || stockout_days || ' days)' AS label,
          risk_category AS risk_level FROM stockout_mart""",
    ),
)
def _(t):
    return ws.stockout_bars(kpis.stockout_frequency(t))


@query(
    "stock_status_distribution",
    with_(STOCK, f"SELECT stock_status, count(DISTINCT product_id) AS products FROM stock WHERE {_NOW} GROUP BY 1"),
)
def _(t):
    return ws.status_distribution(t.fact_inventory())


# Relationships and interaction ------------------------------------------------


@query(
    "sales_related_to_production",
    with_(
        SALES,
        PRODUCTION,
        SALES_MONTHLY,
        PRODUCTION_MONTHLY,
        f"""SELECT financial_year, month_name, year, {dbl('net_revenue')} AS net_revenue, total_actual, efficiency_pct
        FROM sales_mart LEFT JOIN production_mart USING (financial_year, month_name, year)""",
    ),
)
def _(t):
    return ws.sales_with_production(kpis.sales_monthly(t), kpis.production_monthly(t))


@query(
    "blended_revenue_share",
    with_(
        SALES,
        ACCOUNTS,
        f"""
a AS (SELECT financial_year, SUM(net_amount) AS r FROM sales GROUP BY 1),
b AS (SELECT financial_year, SUM(invoice_amount) AS v FROM accounts GROUP BY 1)""",
        f"""SELECT financial_year, {dbl('r')} AS revenue, {dbl('v')} AS billed,
          {pct('r', 'SUM(r) OVER ()', 4)} AS revenue_share_pct FROM a LEFT JOIN b USING (financial_year)""",
    ),
)
def _(t):
    return ws.blended_share(kpis.sales_monthly(t), kpis.billing_collections(t))


_PICK = "SELECT category FROM sales GROUP BY 1 ORDER BY SUM(net_amount) DESC, 1 LIMIT 2"


@query(
    "action_filter_by_marks",
    with_(
        SALES,
        f"""SELECT year, month, {dbl('SUM(net_amount)')} AS net_revenue FROM sales
        WHERE category IN ({_PICK}) GROUP BY 1, 2""",
    ),
)
def _(t):
    sales = t.fact_sales(product=True)
    marks = (
        sales.groupBy("category").agg(F.sum("net_amount").alias("r"))
        .orderBy(F.col("r").desc(), "category").limit(2)
    )
    return ws.filtered_by_marks(sales, marks, ["category"])


@query(
    "slicers_on_revenue",
    with_(
        SALES,
        f"""SELECT year, month, payment_mode, {dbl('SUM(net_amount)')} AS net_revenue FROM sales
        WHERE financial_year IN ('FY1996-97', 'FY1997-98') AND quarter = 'Q2'
          AND payment_mode IN ('1-URGENT', '5-LOW') GROUP BY 1, 2, 3""",
    ),
)
def _(t):
    rows = slice_rows(
        t.fact_sales(),
        financial_year=["FY1996-97", "FY1997-98"],
        quarter="Q2",
        payment_mode=["1-URGENT", "5-LOW"],
        month=None,
    )
    return rows.groupBy("year", "month", "payment_mode").agg(
        F.sum("net_amount").alias("net_revenue")
    )


