"""Cleaning jobs, their rule counters and summaries."""

from __future__ import annotations


from depotflow.plans.accounts_cleaning import accounts_rule_counts, accounts_rule_violations, clean_accounts
from depotflow.plans.inventory_cleaning import clean_inventory, inventory_rule_counts, inventory_rule_violations
from depotflow.plans.production_cleaning import (
    clean_production,
    production_rule_counts,
    production_rule_violations,
)
from depotflow.plans.quality import (
    accounts_cleaning_summary,
    inventory_cleaning_summary,
    production_cleaning_summary,
    sales_cleaning_summary,
)
from depotflow.plans.sales_cleaning import clean_sales, sales_rule_counts, sales_rule_violations
from depotflow.registry.base import query
from depotflow.registry.sqltext import (
    END,
    SALES_CATEGORIES,
    SALES_END,
    SALES_MODES,
    SALES_ROUTES,
    SALES_START,
    SALES_TYPES,
    START,
    CLEAN_ACCOUNTS,
    CLEAN_INVENTORY,
    CLEAN_PRODUCTION,
    CLEAN_SALES,
    USABLE_SALES,
    big,
    dbl,
    iso,
    members,
    moment,
    pct,
    rnd,
    raw_div,
    with_,
)
from depotflow.sources.order_tables import (
    ACCOUNTS_RULES,
    INVENTORY_RULES,
    PRODUCTION_RULES,
    SALES_RULES,
    OrderTables,
)


def cleaned_sales(t: OrderTables):
    return clean_sales(t.raw_sales(), t.RAW_SALES_ORDER, SALES_RULES)


def cleaned_production(t: OrderTables):
    return clean_production(t.raw_production(), t.RAW_PRODUCTION_ORDER, PRODUCTION_RULES)


def cleaned_inventory(t: OrderTables):
    return clean_inventory(t.raw_inventory(), t.RAW_INVENTORY_ORDER, INVENTORY_RULES)


def cleaned_accounts(t: OrderTables):
    return clean_accounts(t.raw_accounts(), t.RAW_ACCOUNTS_ORDER, ACCOUNTS_RULES)


def _columns(text=(), whole=(), real=(), dates=(), flags=()) -> tuple[list[str], str]:
    """Column list for the DataFrame and the matching typed SELECT list."""
    sql = [*text, *flags]
    sql += [f"{big(c)} AS {c}" for c in whole]
    sql += [f"{dbl(c)} AS {c}" for c in real]
    sql += [f"{iso(c)} AS {c}" for c in dates]
    return [*text, *flags, *whole, *real, *dates], ", ".join(sql)


_SALES, _SALES_SQL = _columns(
    text=("sale_id", "month_name", "quarter", "customer_name", "customer_type", "route_name",
          "product_name", "category", "unit", "payment_mode", "data_quality_flag", "day_of_week",
          "financial_year", "revenue_band"),
    flags=("is_weekend",),
    whole=("year", "month", "customer_id", "route_id", "product_id", "invoice_number"),
    real=("quantity", "unit_price", "gross_amount", "discount", "net_amount"),
    dates=("date",),
)
_RUNS, _RUNS_SQL = _columns(
    text=("production_id", "category", "shift", "day_of_week", "financial_year",
          "efficiency_band", "data_quality_flag", "batch_number"),
    real=("planned_qty", "actual_qty", "wastage_qty", "net_produced_qty", "raw_milk_used_l",
          "production_efficiency_pct", "wastage_rate_pct"),
    dates=("date",),
)
_STOCK, _STOCK_SQL = _columns(
    text=("inventory_id", "product_id", "product_name", "category", "stock_status",
          "financial_year", "day_of_week", "shelf_life_risk"),
    whole=("shelf_life_days",),
    real=("opening_stock", "received_qty", "dispatched_qty", "closing_stock", "reorder_level",
          "days_of_stock"),
    dates=("date",),
)
_INVOICES, _INVOICES_SQL = _columns(
    text=("transaction_id", "customer_name", "customer_type", "payment_status", "financial_year",
          "aging_bucket"),
    whole=("customer_id", "invoice_number", "days_overdue", "days_to_payment"),
    real=("invoice_amount", "amount_paid", "outstanding_balance", "credit_days",
          "collection_efficiency_pct"),
    dates=("invoice_date", "due_date", "payment_date"),
)


@query("clean_sales", with_(CLEAN_SALES, f"SELECT {_SALES_SQL} FROM cleaned"))
def _(t):
    return cleaned_sales(t).select(*_SALES)


@query("clean_production", with_(CLEAN_PRODUCTION, f"SELECT {_RUNS_SQL} FROM cleaned"))
def _(t):
    return cleaned_production(t).select(*_RUNS)


@query("clean_inventory", with_(CLEAN_INVENTORY, f"SELECT {_STOCK_SQL} FROM cleaned"))
def _(t):
    return cleaned_inventory(t).select(*_STOCK)


@query("clean_accounts", with_(CLEAN_ACCOUNTS, f"SELECT {_INVOICES_SQL} FROM cleaned"))
def _(t):
    return cleaned_accounts(t).select(*_INVOICES)


_MEASURES = ("quantity", "unit_price", "gross_amount", "discount", "net_amount")


def _not_in(col, values):
    return f"count(*) FILTER (WHERE {col} IS NULL OR {col} NOT IN {members(values)})"


@query(
    "sales_rule_counts",
    with_(
        USABLE_SALES,
        f"""SELECT {_not_in('category', SALES_CATEGORIES)} AS invalid_category,
          {_not_in('payment_mode', SALES_MODES)} AS invalid_payment_mode,
          {_not_in('customer_type', SALES_TYPES)} AS invalid_customer_type,
          {_not_in('route_name', SALES_ROUTES)} AS invalid_route,
          count(*) FILTER (WHERE abs({dbl('gross_amount')} - {dbl('round(quantity * unit_price, 2)')})
            / abs(NULLIF({dbl('round(quantity * unit_price, 2)')}, 0)) > 0.01
            AND quantity * unit_price > 0) AS gross_not_quantity_times_price,
          count(*) FILTER (WHERE abs(net_amount - round(gross_amount - discount, 2)) > 1) AS net_not_gross_less_discount,
          count(*) FILTER (WHERE {pct('discount', 'gross_amount')} > 20) AS discount_above_20_percent,
          count(*) FILTER (WHERE net_amount <= 0) AS net_not_positive,
          {', '.join(f'count(*) FILTER (WHERE {m} < 0) AS negative_{m}' for m in _MEASURES)}
        FROM usable""",
    ),
)
def _(t):
    return sales_rule_counts(t.raw_sales(), SALES_RULES)


@query(
    "production_rule_counts",
    with_(
        CLEAN_PRODUCTION,
        f"""SELECT {_not_in('category', PRODUCTION_RULES.categories)} AS invalid_category,
          {_not_in('shift', PRODUCTION_RULES.shifts)} AS invalid_shift,
          count(*) FILTER (WHERE actual_qty > planned_qty * CAST('1.10' AS DECIMAL(3,2))) AS over_production,
          count(*) FILTER (WHERE wastage_qty > actual_qty) AS wastage_above_actual
        FROM cleaned_usable""",
    ),
)
def _(t):
    return production_rule_counts(t.raw_production(), PRODUCTION_RULES)


@query(
    "inventory_rule_counts",
    with_(
        CLEAN_INVENTORY,
        """SELECT count(*) FILTER (WHERE abs(closing_stock - (opening_stock + received_qty - dispatched_qty)) > 1)
            AS closing_not_balanced,
          count(*) FILTER (WHERE dispatched_qty > opening_stock + received_qty) AS over_dispatched
        FROM cleaned_usable""",
    ),
)
def _(t):
    return inventory_rule_counts(t.raw_inventory(), INVENTORY_RULES)


@query(
    "accounts_rule_counts",
    with_(
        CLEAN_ACCOUNTS,
        """SELECT count(*) FILTER (WHERE abs(outstanding_balance - round(invoice_amount - amount_paid, 2)) > 1)
            AS balance_not_reconciled,
          count(*) FILTER (WHERE amount_paid > invoice_amount) AS overpaid,
          count(*) FILTER (WHERE payment_date IS NULL) AS no_payment_date
        FROM cleaned_usable""",
    ),
)
def _(t):
    return accounts_rule_counts(t.raw_accounts(), ACCOUNTS_RULES)


def _violations(row_id: str, table: str, rules: dict[str, tuple]) -> str:
    """One SELECT per rule over the usable rows: condition, and text, value and expected value shown."""

    def rows(name, broken, text="NULL", value="NULL", expected="NULL"):
        return f"""SELECT {row_id}, '{name}' AS rule, CAST({text} AS VARCHAR) AS found_text,
          {dbl(value)} AS found_value, {dbl(expected)} AS expected_value FROM {table} WHERE {broken}"""

    return "\nUNION ALL ".join(rows(name, *spec) for name, spec in rules.items())


def _stranger(col: str, values) -> tuple:
    return f"({col} IS NULL OR {col} NOT IN {members(values)})", col


_TIMES = "round(quantity * unit_price, 2)"
_SALES_VIOLATIONS = {
    "invalid_category": _stranger("category", SALES_CATEGORIES),
    "invalid_payment_mode": _stranger("payment_mode", SALES_MODES),
    "invalid_customer_type": _stranger("customer_type", SALES_TYPES),
    "invalid_route": _stranger("route_name", SALES_ROUTES),
    "gross_not_quantity_times_price": (
        f"{_TIMES} > 0 AND abs({dbl('gross_amount')} - {dbl(_TIMES)}) / {dbl(_TIMES)} > 0.01", "NULL", "gross_amount", _TIMES
    ),
    "net_not_gross_less_discount": (
        "abs(net_amount - round(gross_amount - discount, 2)) > 1", "NULL", "net_amount", "round(gross_amount - discount, 2)"
    ),
    "discount_above_20_percent": (f"{pct('discount', 'gross_amount')} > 20", "NULL", pct("discount", "gross_amount"), "20"),
    "net_not_positive": ("net_amount <= 0", "NULL", "net_amount", "0"),
    **{f"negative_{m}": (f"{m} < 0", "NULL", m, "0") for m in _MEASURES},
}
_MOST = "planned_qty * CAST('1.10' AS DECIMAL(3,2))"
_PRODUCTION_VIOLATIONS = {
    "invalid_category": _stranger("category", PRODUCTION_RULES.categories),
    "invalid_shift": _stranger("shift", PRODUCTION_RULES.shifts),
    "over_production": (f"actual_qty > {_MOST}", "NULL", "actual_qty", _MOST),
    "wastage_above_actual": ("wastage_qty > actual_qty", "NULL", "wastage_qty", "actual_qty"),
}
_INVENTORY_VIOLATIONS = {
    "closing_not_balanced": (
        "abs(closing_stock - (opening_stock + received_qty - dispatched_qty)) > 1", "NULL", "closing_stock",
        "opening_stock + received_qty - dispatched_qty",
    ),
    "over_dispatched": ("dispatched_qty > opening_stock + received_qty", "NULL", "dispatched_qty", "opening_stock + received_qty"),
}
_ACCOUNTS_VIOLATIONS = {
    "balance_not_reconciled": (
        "abs(outstanding_balance - round(invoice_amount - amount_paid, 2)) > 1", "NULL", "outstanding_balance",
        "round(invoice_amount - amount_paid, 2)",
    ),
    "overpaid": ("amount_paid > invoice_amount", "NULL", "amount_paid", "invoice_amount"),
    "no_payment_date": ("payment_date IS NULL",),
}


@query("sales_rule_violations", with_(USABLE_SALES, _violations("sale_id", "usable", _SALES_VIOLATIONS)))
def _(t):
    return sales_rule_violations(t.raw_sales(), SALES_RULES)


@query(
    "production_rule_violations",
    with_(CLEAN_PRODUCTION, _violations("production_id", "cleaned_usable", _PRODUCTION_VIOLATIONS)),
)
def _(t):
    return production_rule_violations(t.raw_production(), PRODUCTION_RULES)


@query(
    "inventory_rule_violations",
    with_(CLEAN_INVENTORY, _violations("inventory_id", "cleaned_usable", _INVENTORY_VIOLATIONS)),
)
def _(t):
    return inventory_rule_violations(t.raw_inventory(), INVENTORY_RULES)


@query(
    "accounts_rule_violations",
    with_(CLEAN_ACCOUNTS, _violations("transaction_id", "cleaned_usable", _ACCOUNTS_VIOLATIONS)),
)
def _(t):
    return accounts_rule_violations(t.raw_accounts(), ACCOUNTS_RULES)


def _rows_in(table: str) -> str:
    return f"(SELECT count(*) FROM {table})"


def _dropped(raw: str, usable: str, date: str, start: str, end: str) -> str:
    """Input rows and rows dropped by reason, each counted on its own."""
    when = moment(date)
    inside = f"{when} BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"
    rows = lambda cond: f"(SELECT count(*) FROM {raw} WHERE {cond})"
    return f"""{_rows_in(raw)} AS input_rows, {_rows_in(raw)} - count(*) AS dropped_rows,
          {rows(f'{when} IS NULL')} AS dropped_bad_date, {rows(f'{when} IS NOT NULL AND NOT ({inside})')} AS dropped_outside_dates,
          {rows(inside)} - {_rows_in(usable)} AS dropped_missing_value, {_rows_in(usable)} - count(*) AS dropped_duplicate"""


@query(
    "clean_sales_summary",
    with_(
        CLEAN_SALES,
        f"""SELECT count(*) AS output_rows, {iso('min(date)')} AS first_date, {iso('max(date)')} AS last_date,
          {dbl('SUM(net_amount)')} AS total_net_revenue, count(DISTINCT customer_id) AS unique_customers,
          count(DISTINCT product_id) AS unique_products,
          {_dropped('raw_sales', 'usable', 'date', SALES_START, SALES_END)} FROM cleaned""",
    ),
)
def _(t):
    return sales_cleaning_summary(t.raw_sales(), t.RAW_SALES_ORDER, SALES_RULES)


@query(
    "clean_production_summary",
    with_(
        CLEAN_PRODUCTION,
        f"""SELECT count(*) AS output_rows,
          {rnd(raw_div('SUM(CAST(production_efficiency_pct AS DECIMAL(18,2)))', 'COUNT(production_efficiency_pct)'))} AS avg_efficiency_pct,
          {rnd(raw_div('SUM(CAST(wastage_rate_pct AS DECIMAL(18,2)))', 'COUNT(wastage_rate_pct)'))} AS avg_wastage_pct,
          {dbl('SUM(raw_milk_used_l)')} AS total_raw_milk_l,
          {_dropped('raw_production', 'cleaned_usable', 'date', START, END)} FROM cleaned""",
    ),
)
def _(t):
    return production_cleaning_summary(t.raw_production(), t.RAW_PRODUCTION_ORDER, PRODUCTION_RULES)


@query(
    "clean_inventory_summary",
    with_(
        CLEAN_INVENTORY,
        f"""SELECT count(*) AS output_rows,
          {', '.join(f"count(*) FILTER (WHERE stock_status = '{s}') AS {s.lower()}_rows" for s in ('Stockout', 'Critical', 'Low', 'OK'))},
          count(*) FILTER (WHERE shelf_life_risk = 'At Risk') AS shelf_life_at_risk,
          {_dropped('raw_inventory', 'cleaned_usable', 'date', START, END)} FROM cleaned""",
    ),
)
def _(t):
    return inventory_cleaning_summary(t.raw_inventory(), t.RAW_INVENTORY_ORDER, INVENTORY_RULES)


@query(
    "clean_accounts_summary",
    with_(
        CLEAN_ACCOUNTS,
        f"""SELECT count(*) AS output_rows, {dbl('SUM(invoice_amount)')} AS total_billed,
          {dbl('SUM(amount_paid)')} AS total_collected, {dbl('SUM(outstanding_balance)')} AS total_outstanding,
          {pct('SUM(amount_paid)', 'SUM(invoice_amount)')} AS collection_efficiency_pct,
          count(*) FILTER (WHERE payment_status = 'Paid') AS paid_invoices,
          count(*) FILTER (WHERE payment_status = 'Paid Late') AS paid_late_invoices,
          count(*) FILTER (WHERE payment_status = 'OverDue') AS overdue_invoices,
          count(*) FILTER (WHERE aging_bucket = '90+ Days') AS overdue_90_plus,
          {_dropped('raw_accounts', 'cleaned_usable', 'invoice_date', START, END)} FROM cleaned""",
    ),
)
def _(t):
    return accounts_cleaning_summary(t.raw_accounts(), t.RAW_ACCOUNTS_ORDER, ACCOUNTS_RULES)
