"""Single operators, each over whole tables."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from depotflow.functions import calendar as cal
from depotflow.functions.numeric import floor_at_zero, percent, right_closed_bin, to_number
from depotflow.functions.text import is_member, strip, strip_all, title_case
from depotflow.operators.dedup import keep_first
from depotflow.operators.share import share_of_all
from depotflow.operators.timeline import day_spine
from depotflow.plans.accounts_cleaning import clean_accounts
from depotflow.plans.cleaning import numbers_set_aside
from depotflow.plans.dimensions import dim_date, star_read
from depotflow.plans.inventory_cleaning import clean_inventory
from depotflow.plans.sales_cleaning import BAND_EDGES, BAND_LABELS
from depotflow.registry.base import query
from depotflow.registry.cleaning import _INVOICES, _INVOICES_SQL, _STOCK, _STOCK_SQL
from depotflow.registry.sqltext import (
    SALES_CATEGORIES,
    SALES_MODES,
    SALES_ROUTES,
    SALES_TYPES,
    RAW_ACCOUNTS,
    RAW_INVENTORY,
    RAW_RUNS,
    RAW_SALES,
    SALES,
    big,
    clean_invoices,
    clean_stock,
    dbl,
    fy,
    iso,
    members,
    moment,
    number,
    pct,
    stripped,
    title,
    with_,
)
from depotflow.sources.files import preview
from depotflow.sources.order_tables import ACCOUNTS_RULES, INVENTORY_RULES, SALES_RULES

# Dimensions -------------------------------------------------------------------


@query(
    "dim_date",
    f"""SELECT {iso('d')} AS date_key, dayname(d) AS day_of_week, dayofweek(d) AS day_number, week(d) AS week_number,
      month(d) AS month_number, monthname(d) AS month_name, 'Q' || quarter(d) AS quarter, year(d) AS year,
      {fy('d')} AS financial_year, isodow(d) >= 6 AS is_weekend, last_day(d) = d AS is_month_end,
      CASE WHEN month(d) IN (3, 4, 5) THEN 'Summer' WHEN month(d) IN (6, 7, 8, 9) THEN 'Monsoon'
           WHEN month(d) IN (10, 11) THEN 'Autumn' ELSE 'Winter' END AS season
    FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
      INTERVAL 1 DAY)) AS DATE) AS d)""",
)
def _(t):
    return dim_date(day_spine(t.table("orders"), "o_orderdate"))


@query(
    "dim_product",
    f"""SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
      {dbl('CAST(p_retailprice AS DECIMAL(18,2))')} AS standard_price, {big('p_size')} AS size, p_brand AS brand FROM part""",
)
def _(t):
    return t.dim_product


@query(
    "dim_route",
    f"""SELECT {big('n_nationkey')} AS route_id, n_name AS route_name, r_name AS area
    FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _(t):
    return t.dim_route


@query(
    "dim_customer",
    f"""SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
      {big('c_nationkey')} AS route_id,
      {big("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'HOUSEHOLD' THEN 30 WHEN 'MACHINERY' THEN 45 ELSE 15 END")} AS credit_days,
      {dbl('CAST(c_acctbal AS DECIMAL(18,2))')} AS credit_limit FROM customer""",
)
def _(t):
    return t.dim_customer


@query(
    "star_read",
    with_(
        SALES,
        f"""SELECT r_name AS area, p_brand AS brand, customer_type,
          CASE WHEN month(date) IN (3, 4, 5) THEN 'Summer' WHEN month(date) IN (6, 7, 8, 9) THEN 'Monsoon'
               WHEN month(date) IN (10, 11) THEN 'Autumn' ELSE 'Winter' END AS season,
          {dbl('SUM(net_amount)')} AS revenue, count(*) AS lines
        FROM sales LEFT JOIN part ON p_partkey = product_id
          LEFT JOIN nation ON n_nationkey = route_id LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
    ),
)
def _(t):
    calendar = dim_date(day_spine(t.table("orders"), "o_orderdate")).withColumnRenamed("date_key", "date")
    star = star_read(
        t.fact_sales(),
        {
            "calendar": (calendar, "date", ["season"]),
            "product": (t.dim_product, "product_id", ["brand"]),
            "customer": (t.dim_customer, "customer_id", ["customer_type", "route_id"]),
            "route": (t.dim_route, "route_id", ["area"]),
        },
    )
    return star.groupBy("area", "brand", "customer_type", "season").agg(
        F.sum("net_amount").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )


# Cleaning steps ---------------------------------------------------------------


@query(
    "text_standardised",
    with_(
        RAW_SALES,
        f"""SELECT {title(stripped('category'))} AS category, {title(stripped('customer_type'))} AS customer_type,
          {title(stripped('category'))} IN {members(SALES_CATEGORIES)} AS category_valid,
          {title(stripped('customer_type'))} IN {members(SALES_TYPES)} AS type_valid,
          count(*) AS lines, count(DISTINCT category) AS spellings
        FROM raw_sales GROUP BY ALL""",
    ),
)
def _(t):
    raw = t.raw_sales().select("category", "customer_type")
    clean = raw.withColumns(
        {
            "_raw": F.col("category"),
            "category": title_case(strip(F.col("category"))),
            "customer_type": title_case(strip(F.col("customer_type"))),
        }
    )
    return clean.groupBy(
        "category", "customer_type",
        is_member(F.col("category"), SALES_RULES.categories).alias("category_valid"),
        is_member(F.col("customer_type"), SALES_RULES.customer_types).alias("type_valid"),
    ).agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("_raw").alias("spellings"))


@query(
    "dates_parsed",
    with_(
        RAW_SALES,
        f"""SELECT CASE WHEN d IS NULL THEN 'unparseable'
            WHEN d BETWEEN TIMESTAMP '1996-04-01' AND TIMESTAMP '2000-03-31' THEN 'kept'
            ELSE 'out of range' END AS outcome, count(*) AS lines, {iso('min(d)')} AS first_day, {iso('max(d)')} AS last_day
        FROM (SELECT {moment('date')} AS d FROM raw_sales) GROUP BY 1""",
    ),
)
def _(t):
    raw = strip_all(t.raw_sales().select("date"))
    rows = raw.select(cal.to_moment(raw, "date").alias("d"))
    low, high = (F.lit(str(d)).cast("timestamp_ntz") for d in (SALES_RULES.start, SALES_RULES.end))
    outcome = (
        F.when(F.col("d").isNull(), "unparseable")
        .when(F.col("d").between(low, high), "kept")
        .otherwise("out of range")
    )
    return rows.groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("d").cast("date").alias("first_day"),
        F.max("d").cast("date").alias("last_day"),
    )


_NUMBERS = ("quantity", "unit_price", "gross_amount", "discount", "net_amount")


@query(
    "numbers_coerced",
    with_(
        RAW_SALES,
        "SELECT " + ", ".join(
            f"count(*) FILTER (WHERE {number(c)} IS NULL) AS {c}_missing, {dbl(f'SUM({number(c)})')} AS {c}_total"
            for c in _NUMBERS
        ) + f""", count(*) FILTER (WHERE {number('quantity')} IS NOT NULL AND {number('unit_price')} IS NOT NULL
            AND {number('net_amount')} IS NOT NULL) AS usable_lines FROM raw_sales""",
    ),
)
def _(t):
    rows = strip_all(t.raw_sales().select(*_NUMBERS))
    rows = rows.select(*[to_number(F.col(c)).alias(c) for c in _NUMBERS])
    usable = F.col("quantity").isNotNull() & F.col("unit_price").isNotNull() & F.col("net_amount").isNotNull()
    return rows.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in _NUMBERS],
        *[F.sum(c).alias(f"{c}_total") for c in _NUMBERS],
        F.count_if(usable).alias("usable_lines"),
    )


# Quantities with an exponent, so that some are beyond 28 digits before the point.
_EXPONENTS = "l_quantity::INT::VARCHAR || 'e' || (l_partkey % 30)::VARCHAR"


@query(
    "numbers_set_aside",
    f"""SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS sale_id, 'quantity' AS "column",
      {_EXPONENTS} AS text, 'too large' AS reason
    FROM lineitem WHERE l_quantity >= 1 AND length(l_quantity::INT::VARCHAR) + l_partkey % 30 > 28""",
)
def _(t):
    lines = t.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("sale_id"),
        F.concat(F.col("l_quantity").cast("int"), F.lit("e"), F.col("l_partkey") % 30).alias("quantity"),
    )
    return numbers_set_aside(lines, "sale_id", ["quantity"])


@query(
    "negatives_floored",
    with_(
        RAW_RUNS,
        f"""SELECT {stripped('category')} AS category,
          {dbl(f"SUM(CASE WHEN {number('planned_qty')} < 0 THEN 0 ELSE {number('planned_qty')} END)")} AS planned,
          count(*) FILTER (WHERE {number('planned_qty')} < 0) AS raised,
          count(*) FILTER (WHERE {number('actual_qty')} IS NULL) AS still_missing
        FROM raw_production GROUP BY 1""",
    ),
)
def _(t):
    rows = strip_all(t.raw_production().select("category", "planned_qty", "actual_qty"))
    planned, actual = to_number(F.col("planned_qty")), to_number(F.col("actual_qty"))
    return rows.groupBy("category").agg(
        F.sum(floor_at_zero(planned)).alias("planned"),
        F.count_if(planned < 0).alias("raised"),
        F.count_if(floor_at_zero(actual).isNull()).alias("still_missing"),
    )


@query(
    "keep_first_copy",
    f"""SELECT l_orderkey, {big('l_linenumber')} AS l_linenumber, l_partkey, {dbl('l_extendedprice')} AS l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem) WHERE n = 1""",
)
def _(t):
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    first = keep_first(
        lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )
    return first.drop("l_suppkey")


@query(
    "safe_ratio",
    with_(
        RAW_ACCOUNTS,
        f"""SELECT customer_type, count(*) AS invoices, count({pct('outstanding_balance', 'credit_days')}) AS with_ratio,
          {pct("SUM(CAST(outstanding_balance AS DECIMAL(18,2)))", 'SUM(credit_days)')} AS open_per_credit_day
        FROM raw_accounts GROUP BY 1""",
    ),
)
def _(t):
    rows = t.raw_accounts()
    open_ = to_number(F.col("outstanding_balance"))
    return rows.groupBy("customer_type").agg(
        F.count(F.lit(1)).alias("invoices"),
        F.count(percent(open_, F.col("credit_days"))).alias("with_ratio"),
        percent(F.sum(open_), F.sum("credit_days")).alias("open_per_credit_day"),
    )


@query(
    "calendar_fields",
    f"""SELECT {iso('d')} AS date, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend, {fy('d')} AS financial_year,
      'Q' || quarter(d) AS quarter, count(*) AS orders
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY d""",
)
def _(t):
    day = F.col("date")
    days = t.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return days.withColumns(
        {
            "day_of_week": cal.day_name(day),
            "is_weekend": cal.is_weekend(day),
            "financial_year": cal.financial_year(day),
            "quarter": cal.quarter_label(day),
        }
    )


@query(
    "revenue_bands",
    with_(
        SALES,
        f"""SELECT financial_year, CASE WHEN net_amount > 10000 THEN '10K+' WHEN net_amount > 5000 THEN '5K-10K'
            WHEN net_amount > 2000 THEN '2K-5K' WHEN net_amount > 500 THEN '500-2K' WHEN net_amount > 0 THEN '<500' END AS band,
          count(*) AS lines, {dbl('SUM(net_amount)')} AS revenue FROM sales GROUP BY 1, 2""",
    ),
)
def _(t):
    band = right_closed_bin(F.col("net_amount"), BAND_EDGES, BAND_LABELS)
    return t.fact_sales().groupBy("financial_year", band.alias("band")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_amount").alias("revenue")
    )


# Corrections limited to the offending rows --------------------------------------


@query(
    "clean_inventory_row_scope",
    with_(RAW_INVENTORY, clean_stock("raw_inventory", "cleaned", "row"), f"SELECT {_STOCK_SQL} FROM cleaned"),
)
def _(t):
    rules = dataclasses.replace(INVENTORY_RULES, correction_scope="row")
    return clean_inventory(t.raw_inventory(), t.RAW_INVENTORY_ORDER, rules).select(*_STOCK)


@query(
    "clean_accounts_row_scope",
    with_(
        RAW_ACCOUNTS,
        clean_invoices("raw_accounts", "invoice_date, invoice_number", "cleaned", "row"),
        f"SELECT {_INVOICES_SQL} FROM cleaned",
    ),
)
def _(t):
    rules = dataclasses.replace(ACCOUNTS_RULES, correction_scope="row")
    return clean_accounts(t.raw_accounts(), t.RAW_ACCOUNTS_ORDER, rules).select(*_INVOICES)


# Shares and previews ------------------------------------------------------------


@query(
    "customer_revenue_share",
    with_(
        SALES,
        f"""SELECT customer_id, {dbl('SUM(net_amount)')} AS revenue,
          {pct('SUM(net_amount)', 'SUM(SUM(net_amount)) OVER ()', 4)} AS share_pct FROM sales GROUP BY 1""",
    ),
)
def _(t):
    totals = t.fact_sales().groupBy("customer_id").agg(F.sum("net_amount").alias("revenue"))
    return share_of_all(totals, "revenue", "share_pct", scale=4)


@query(
    "row_preview",
    with_(
        SALES,
        f"""SELECT sale_id, product_id, {iso('date')} AS date, {dbl('net_amount')} AS net_amount FROM sales
        ORDER BY date, sale_id, product_id, net_amount LIMIT 5""",
    ),
)
def _(t):
    rows = t.fact_sales().select("sale_id", "product_id", "date", "net_amount")
    return preview(rows, 5, "date", "sale_id", "product_id", "net_amount")
