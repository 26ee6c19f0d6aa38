"""SQL fragments of the twins: the star schema derived from the order tables again,
written for DuckDB and independent of the DataFrame code."""

from __future__ import annotations

# The twins state every constant themselves, so a change in the library turns them red.
START, END, ANALYSIS_DATE = "1995-01-01", "2001-12-31", "2001-08-31"
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SHELF_LIFE = {"ECONOMY": 2, "LARGE": 3, "MEDIUM": 7, "PROMO": 5, "SMALL": 180}
CREDIT_DAYS = {"AUTOMOBILE": 0, "BUILDING": 15, "FURNITURE": 15, "HOUSEHOLD": 30, "MACHINERY": 45}
SALES_START, SALES_END = "1996-04-01", "2000-03-31"
SALES_CATEGORIES = ("Economy", "Large", "Medium", "Promo", "Small", "Standard")
SALES_MODES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
SALES_TYPES = ("Automobile", "Building", "Furniture", "Household", "Machine/Tools")
SALES_ROUTES = tuple(f"Nation_{i}" for i in range(24))

WS = r"E' \t\n'"
NUM = "DECIMAL(38,10)"


# Scalars ----------------------------------------------------------------------


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def rnd(x: str, scale: int = 2) -> str:
    """Round a double once, on its shortest decimal form."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {scale}) AS DOUBLE)"


def pct(num: str, den: str, scale: int = 2) -> str:
    return rnd(f"{dbl(num)} * 100.0::DOUBLE / NULLIF({dbl(den)}, 0)", scale)


def div(num: str, den: str, scale: int = 2) -> str:
    return rnd(f"{dbl(num)} / NULLIF({dbl(den)}, 0)", scale)


def raw_div(num: str, den: str) -> str:
    return f"({dbl(num)} / NULLIF({dbl(den)}, 0))"


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def fy(d: str) -> str:
    y = f"year({d} - INTERVAL 3 MONTH)"
    return f"('FY' || {y} || '-' || lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0'))"


def periods(d: str) -> str:
    return (
        f"year({d}) AS year, month({d}) AS month, monthname({d}) AS month_name, "
        f"'Q' || quarter({d}) AS quarter, {fy(d)} AS financial_year"
    )


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def stripped(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {WS})"


def number(x: str) -> str:
    return f"TRY_CAST({stripped(x)} AS {NUM})"


def moment(x: str) -> str:
    return f"TRY_CAST({stripped(x)} AS TIMESTAMP)"


def steps(x: str, rules, rest: str, op: str = ">=") -> str:
    whens = " ".join(f"WHEN {x} {op} {t} THEN '{label}'" for t, label in rules)
    return f"CASE {whens} ELSE '{rest}' END"


def members(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in sorted(values)) + ")"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def number_text(x: str, scale: int) -> str:
    value = f"CAST(round(CAST({x} AS DECIMAL(38,8)), {scale}) AS DECIMAL(30,{max(scale, 1)}))"
    return rf"regexp_replace(CAST({value} AS VARCHAR), '\.?0+$', '')"


def percent_text(x: str) -> str:
    return f"(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR) || '%')"


# Star tables ------------------------------------------------------------------

SALES = f"""
sales AS (
  SELECT l_orderkey || '-' || l_linenumber AS sale_id, d AS date, {periods('d')},
    o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
    CAST(c_nationkey AS BIGINT) AS route_id, n_name AS route_name,
    l_partkey AS product_id, p_name AS product_name, p_type AS category,
    CAST(l_quantity AS BIGINT) AS quantity,
    CAST({rnd('CAST(gross AS DOUBLE) / l_quantity')} AS DECIMAL(18,2)) AS unit_price,
    gross AS gross_amount, off AS discount, CAST(gross - off AS DECIMAL(18,2)) AS net_amount,
    o_orderpriority AS payment_mode, l_orderkey AS invoice_number,
    l_linenumber, l_returnflag, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price
  FROM (
    SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
      CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
           AS DECIMAL(18,2)) AS off
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN part ON p_partkey = l_partkey
  )
)"""

RAW_SALES = f"""{SALES},
raw_sales AS (
  SELECT sale_id,
    CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN {iso('date')} || ' 10:00:00'
         WHEN l_returnflag = 'A' AND l_linenumber = 5 THEN 'not-a-date'
         ELSE {iso('date')} END AS date,
    year, month, month_name, quarter, customer_id, customer_name,
    CASE customer_type WHEN 'MACHINERY' THEN 'machine/tools' ELSE customer_type END AS customer_type,
    route_id, route_name, product_id, product_name,
    CASE WHEN l_returnflag = 'R' THEN E'\\t ' || lower(category) || E' \\n'
         WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 'UNKNOWN RANGE' ELSE category END AS category,
    'Piece' AS unit,
    CASE WHEN l_returnflag = 'A' AND l_linenumber = 4 THEN 'abc'
         WHEN l_returnflag = 'A' AND l_linenumber = 3 THEN '-' || quantity
         ELSE CAST(quantity AS VARCHAR) END AS quantity,
    CASE WHEN l_returnflag = 'R' THEN CAST(list_price AS VARCHAR) ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
    CAST(gross_amount AS VARCHAR) AS gross_amount,
    CASE WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN '-1'
         WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'n/a'
         ELSE CAST(discount AS VARCHAR) END AS discount,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '0' ELSE CAST(net_amount AS VARCHAR) END AS net_amount,
    ' ' || payment_mode || ' ' AS payment_mode, invoice_number
  FROM sales
)"""

_SALES_NUMBERS = ("quantity", "unit_price", "gross_amount", "discount", "net_amount")
USABLE_SALES = f"""{RAW_SALES},
usable AS (
  SELECT * FROM (
    SELECT sale_id, {moment('date')} AS date, year, month, month_name, quarter, customer_id, customer_name,
      {title(stripped('customer_type'))} AS customer_type, route_id, {title(stripped('route_name'))} AS route_name,
      product_id, product_name, {title(stripped('category'))} AS category, unit,
      {', '.join(f'{number(c)} AS {c}' for c in _SALES_NUMBERS)},
      {stripped('payment_mode')} AS payment_mode, invoice_number
    FROM raw_sales)
  WHERE date BETWEEN TIMESTAMP '{SALES_START}' AND TIMESTAMP '{SALES_END}'
    AND quantity IS NOT NULL AND unit_price IS NOT NULL AND net_amount IS NOT NULL
)"""
CLEAN_SALES = f"""{USABLE_SALES},
cleaned AS (
  SELECT * EXCLUDE (nth) REPLACE (CAST(date AS DATE) AS date),
    CASE WHEN net_amount <= 0 THEN 'ZERO_OR_NEGATIVE_NET' WHEN net_amount < 0 THEN 'NEGATIVE_NET_AMOUNT'
         WHEN discount < 0 THEN 'NEGATIVE_DISCOUNT' WHEN gross_amount < 0 THEN 'NEGATIVE_GROSS_AMOUNT'
         WHEN unit_price < 0 THEN 'NEGATIVE_UNIT_PRICE' WHEN quantity < 0 THEN 'NEGATIVE_QUANTITY'
         WHEN category NOT IN {members(SALES_CATEGORIES)} THEN 'INVALID_CATEGORY' ELSE 'OK' END AS data_quality_flag,
    dayname(date) AS day_of_week, isodow(date) >= 6 AS is_weekend, {fy('date')} AS financial_year,
    CASE WHEN net_amount > 10000 THEN '10K+' WHEN net_amount > 5000 THEN '5K-10K'
         WHEN net_amount > 2000 THEN '2K-5K' WHEN net_amount > 500 THEN '500-2K'
         WHEN net_amount > 0 THEN '<500' END AS revenue_band
  FROM (SELECT *, row_number() OVER (PARTITION BY sale_id
          ORDER BY product_id, gross_amount, quantity, discount NULLS FIRST) AS nth FROM usable)
  WHERE nth = 1
)"""

# Production
RUNS = f"""
runs AS (
  SELECT CAST(o_orderdate AS DATE) AS date, p_type AS category,
    CASE WHEN l_returnflag = 'A' THEN 'Morning' ELSE 'Evening' END AS shift,
    CAST(SUM(q) AS {NUM}) AS planned_qty,
    CAST(SUM(q * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS {NUM}) AS actual_qty,
    CAST(SUM(q * CAST(l_tax AS DECIMAL(4,2))) AS {NUM}) AS wastage_qty,
    CAST(SUM(q * p_size) AS {NUM}) AS raw_milk_used_l
  FROM (SELECT *, CAST(l_quantity AS DECIMAL(20,4)) AS q FROM lineitem)
  JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  GROUP BY ALL
)"""


def clean_runs(source: str, order: str, out: str) -> str:
    """Cleaning rules of production applied to the table expression ``source``."""
    floor = "CASE WHEN {0} < 0 THEN 0 ELSE {0} END"
    return f"""
{out}_usable AS (
  SELECT production_id, date, category, shift, batch_number,
    {', '.join(f"CAST({floor.format(c)} AS {NUM}) AS {c}" for c in ('planned_qty', 'actual_qty', 'wastage_qty'))},
    raw_milk_used_l
  FROM (SELECT production_id, {moment('date')} AS date, {title(stripped('category'))} AS category,
          {title(stripped('shift'))} AS shift, batch_number,
          {', '.join(f"{number(c)} AS {c}" for c in ('planned_qty', 'actual_qty', 'wastage_qty', 'raw_milk_used_l'))}
        FROM {source})
  WHERE date BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'
    AND planned_qty IS NOT NULL AND actual_qty IS NOT NULL
),
{out} AS (
  SELECT * , dayname(date) AS day_of_week,
    CASE WHEN production_efficiency_pct > 110 THEN NULL WHEN production_efficiency_pct > 100 THEN 'Excellent (>100%)'
         WHEN production_efficiency_pct > 95 THEN 'Good (95-100%)' WHEN production_efficiency_pct > 90 THEN 'Fair (90-95%)'
         WHEN production_efficiency_pct > 85 THEN 'Poor (85-90%)' WHEN production_efficiency_pct > 0 THEN 'Critical (<85%)'
    END AS efficiency_band,
    CASE WHEN wastage_rate_pct > 10 THEN 'HIGH_WASTAGE' WHEN production_efficiency_pct > 110 THEN 'OVER_PRODUCTION'
         ELSE 'OK' END AS data_quality_flag
  FROM (
    SELECT production_id, date, {periods('date')}, category, shift, batch_number, planned_qty, actual_qty,
      waste AS wastage_qty, CAST(actual_qty - waste AS {NUM}) AS net_produced_qty, raw_milk_used_l,
      {pct('actual_qty', 'planned_qty')} AS production_efficiency_pct,
      {pct('waste', 'actual_qty')} AS wastage_rate_pct
    FROM (
      SELECT * REPLACE (CAST(date AS DATE) AS date),
        CAST(CASE WHEN wastage_qty > actual_qty THEN 0 ELSE wastage_qty END AS {NUM}) AS waste,
        row_number() OVER (PARTITION BY production_id ORDER BY {order}) AS nth
      FROM {out}_usable)
    WHERE nth = 1)
)"""


_FACT_RUNS = f"""(SELECT *, {iso('date')} || '|' || category || '|' || shift AS production_id,
   {iso('date')} || '/' || shift AS batch_number FROM runs)"""
PRODUCTION = f"{RUNS}, {clean_runs(_FACT_RUNS, 'category', 'production')}"
RAW_RUNS = f"""{RUNS},
raw_production AS (
  SELECT {iso('date')} || '|' || left(category, 1) || '|' || shift AS production_id, {iso('date')} AS date,
    year(date) AS year, month(date) AS month, monthname(date) AS month_name, 'Q' || quarter(date) AS quarter,
    CASE WHEN category = 'LARGE' THEN 'oversize' ELSE ' ' || lower(category) END AS category,
    CASE WHEN shift = 'Morning' THEN E'\\tMORNING ' ELSE 'evening' END AS shift,
    CASE WHEN category = 'PROMO' AND shift = 'Morning' AND planned_qty > 40
         THEN CAST(-planned_qty AS VARCHAR) ELSE CAST(planned_qty AS VARCHAR) END AS planned_qty,
    CASE WHEN planned_qty = 50 THEN 'n/a' ELSE CAST(actual_qty AS VARCHAR) END AS actual_qty,
    CASE WHEN planned_qty < 5 THEN CAST(CAST(actual_qty * 2 AS {NUM}) AS VARCHAR)
         ELSE CAST(wastage_qty AS VARCHAR) END AS wastage_qty,
    CAST(raw_milk_used_l AS VARCHAR) AS raw_milk_used_l,
    CAST(NULL AS {NUM}) AS net_produced_qty, CAST(NULL AS {NUM}) AS "production_efficiency_%",
    CAST(NULL AS {NUM}) AS "wastage_rate_%", {iso('date')} || '/' || shift AS batch_number
  FROM runs
)"""
CLEAN_PRODUCTION = f"{RAW_RUNS}, {clean_runs('raw_production', 'category, actual_qty', 'cleaned')}"

# Stock
_TYPE_CASE = "CASE n % 6 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(PART_TYPES)) + " END"
LEDGER = f"""
moves AS (
  SELECT p_brand AS product_id, CAST(l_shipdate AS DATE) AS date,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS received_qty,
    CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS dispatched_qty
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
),
ledger AS (
  SELECT product_id || '|' || {iso('date')} AS inventory_id, date, product_id, 'Range ' || n AS product_name,
    {_TYPE_CASE} AS category, opening_stock, received_qty, dispatched_qty,
    opening_stock + received_qty - dispatched_qty AS closing_stock, n * 20 AS reorder_level
  FROM (SELECT *, CAST(replace(product_id, 'Brand#', '') AS INTEGER) AS n,
          CAST(greatest(coalesce(SUM(received_qty - dispatched_qty) OVER (PARTITION BY product_id ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS BIGINT) AS opening_stock FROM moves)
)"""
_SHELF = "CASE category " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SHELF_LIFE.items()) + " END"
_STOCK_NUMBERS = ("opening_stock", "received_qty", "dispatched_qty", "closing_stock", "reorder_level")


def clean_stock(source: str, out: str, scope: str = "dataset") -> str:
    unbalanced, too_much = "unbalanced", "too_much"
    if scope == "row":
        unbalanced = "abs(closing_stock - (opening_stock + received_qty - dispatched_qty)) > 1"
        too_much = "dispatched_qty > opening_stock + received_qty"
    return f"""
{out}_usable AS (
  SELECT inventory_id, {moment('date')} AS date, product_id, product_name, category,
    {', '.join(f"CAST(greatest(coalesce({number(c)}, 0), 0) AS {NUM}) AS {c}" for c in _STOCK_NUMBERS)}
  FROM {source} WHERE {moment('date')} BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'
),
{out}_flags AS (
  SELECT bool_or(abs(closing_stock - (opening_stock + received_qty - dispatched_qty)) > 1) AS unbalanced,
    bool_or(dispatched_qty > opening_stock + received_qty) AS too_much FROM {out}_usable
),
{out}_balanced AS (
  SELECT * REPLACE (CAST(date AS DATE) AS date,
    CAST(CASE WHEN {too_much} THEN least(dispatched_qty, opening_stock + received_qty) ELSE dispatched_qty END AS {NUM}) AS dispatched_qty,
    CAST(CASE WHEN {too_much} THEN opening_stock + received_qty - least(dispatched_qty, opening_stock + received_qty)
              WHEN {unbalanced} THEN greatest(opening_stock + received_qty - dispatched_qty, 0)
              ELSE closing_stock END AS {NUM}) AS closing_stock),
    row_number() OVER (PARTITION BY inventory_id ORDER BY date) AS nth
  FROM {out}_usable CROSS JOIN {out}_flags
),
{out}_pace AS (
  SELECT product_id, CAST({rnd(raw_div('SUM(dispatched_qty)', 'COUNT(*)'), 1)} AS {NUM}) AS pace
  FROM {out}_balanced WHERE nth = 1 GROUP BY 1
),
{out} AS (
  SELECT *, CASE WHEN days_of_stock > shelf_life_days THEN 'At Risk' ELSE 'Safe' END AS shelf_life_risk
  FROM (
    SELECT inventory_id, date, {periods('date')}, product_id, product_name, category, opening_stock, received_qty,
      dispatched_qty, closing_stock, reorder_level, dayname(date) AS day_of_week,
      CASE WHEN closing_stock = 0 THEN 'Stockout' WHEN closing_stock * 2 <= reorder_level THEN 'Critical'
           WHEN closing_stock < reorder_level THEN 'Low' ELSE 'OK' END AS stock_status,
      {_SHELF} AS shelf_life_days,
      CAST(CASE WHEN pace > 0 THEN {rnd(raw_div('closing_stock', 'pace'), 1)}
                ELSE closing_stock END AS {NUM}) AS days_of_stock
    FROM {out}_balanced LEFT JOIN {out}_pace USING (product_id) WHERE nth = 1)
)"""


STOCK = f"{LEDGER}, {clean_stock('ledger', 'stock')}"
RAW_INVENTORY = f"""{LEDGER},
raw_inventory AS (
  SELECT product_id || '|' || strftime(date, '%m-%d') AS inventory_id, ' ' || {iso('date')} AS date,
    year(date) AS year, month(date) AS month, monthname(date) AS month_name, 'Q' || quarter(date) AS quarter,
    product_id, product_name, category, opening_stock,
    CASE WHEN received_qty = 0 THEN 'none' ELSE CAST(received_qty AS VARCHAR) END AS received_qty,
    dispatched_qty, CAST(closing_stock AS VARCHAR) AS closing_stock, reorder_level,
    CAST(NULL AS VARCHAR) AS stock_status
  FROM ledger
)"""
CLEAN_INVENTORY = f"{RAW_INVENTORY}, {clean_stock('raw_inventory', 'cleaned')}"

# Receivables
_CREDIT = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CREDIT_DAYS.items()) + " END"
INVOICES = f"""
invoices AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, invoice_date, year(invoice_date) AS year,
    month(invoice_date) AS month, monthname(invoice_date) AS month_name, 'Q' || quarter(invoice_date) AS quarter,
    customer_id, customer_name, customer_type, o_orderkey AS invoice_number,
    CAST(invoice_date + credit_days AS DATE) AS due_date, invoice_amount, amount_paid,
    CAST(invoice_amount - amount_paid AS DECIMAL(18,2)) AS outstanding_balance,
    CASE WHEN o_orderstatus = 'F' THEN CAST(invoice_date + CAST(o_orderkey % 40 AS INTEGER) AS DATE) END AS payment_date,
    credit_days, o_orderpriority AS priority
  FROM (SELECT *, CAST(CASE o_orderstatus WHEN 'F' THEN invoice_amount
            WHEN 'P' THEN round(invoice_amount * CAST('0.60' AS DECIMAL(3,2)), 2) ELSE 0 END AS DECIMAL(18,2)) AS amount_paid
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS invoice_date, CAST(o_totalprice AS DECIMAL(18,2)) AS invoice_amount,
                o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type, {_CREDIT} AS credit_days
              FROM orders LEFT JOIN customer ON c_custkey = o_custkey))
)"""
_ACC_NUMBERS = ("invoice_amount", "amount_paid", "outstanding_balance", "credit_days")
_ACC_DATES = ("invoice_date", "due_date", "payment_date")


def clean_invoices(source: str, order: str, out: str, scope: str = "dataset") -> str:
    unbalanced, overpaid = "unbalanced", "overpaid"
    if scope == "row":
        unbalanced = "abs(outstanding_balance - round(invoice_amount - amount_paid, 2)) > 1"
        overpaid = "amount_paid > invoice_amount"
    return f"""
{out}_usable AS (
  SELECT * FROM (
    SELECT transaction_id, month_name, quarter, year, month, customer_id, customer_name, customer_type, invoice_number,
      {', '.join(f'{moment(c)} AS {c}' for c in _ACC_DATES)}, {', '.join(f'{number(c)} AS {c}' for c in _ACC_NUMBERS)}
    FROM {source})
  WHERE invoice_date BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}' AND invoice_amount IS NOT NULL
),
{out}_flags AS (
  SELECT bool_or(abs(outstanding_balance - round(invoice_amount - amount_paid, 2)) > 1) AS unbalanced,
    bool_or(amount_paid > invoice_amount) AS overpaid FROM {out}_usable
),
{out}_settled AS (
  SELECT * REPLACE (
      CAST(CASE WHEN {overpaid} AND amount_paid > invoice_amount THEN invoice_amount ELSE amount_paid END AS {NUM}) AS amount_paid,
      CAST(CASE WHEN {overpaid} THEN CASE WHEN amount_paid > invoice_amount THEN 0 ELSE invoice_amount - amount_paid END
                WHEN {unbalanced} THEN CASE WHEN round(invoice_amount - amount_paid, 2) < 0 THEN 0
                                          ELSE round(invoice_amount - amount_paid, 2) END
                ELSE outstanding_balance END AS {NUM}) AS outstanding_balance),
    row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) AS nth
  FROM {out}_usable CROSS JOIN {out}_flags
),
{out} AS (
  SELECT transaction_id, CAST(invoice_date AS DATE) AS invoice_date, year, month, month_name, quarter, financial_year,
    customer_id, customer_name, customer_type, invoice_number, CAST(due_date AS DATE) AS due_date, invoice_amount,
    amount_paid, outstanding_balance, CAST(payment_date AS DATE) AS payment_date, days_to_payment, payment_status,
    credit_days, days_overdue, collection_efficiency_pct,
    CASE WHEN payment_status <> 'OverDue' THEN 'Not OverDue' WHEN days_overdue <= 30 THEN '1-30 Days'
         WHEN days_overdue <= 60 THEN '31-60 Days' WHEN days_overdue <= 90 THEN '61-90 Days' ELSE '90+ Days' END AS aging_bucket
  FROM (
    SELECT *, {fy('invoice_date')} AS financial_year,
      CASE WHEN payment_status <> 'OverDue' THEN 0 WHEN due_date IS NULL THEN NULL
           ELSE greatest(date_diff('day', CAST(due_date AS DATE), DATE '{ANALYSIS_DATE}'), 0) END AS days_overdue,
      CASE WHEN eff > 100 THEN 100 WHEN eff < 0 THEN 0 ELSE eff END AS collection_efficiency_pct,
      date_diff('day', CAST(invoice_date AS DATE), CAST(payment_date AS DATE)) AS days_to_payment
    FROM (
      SELECT *, {pct('amount_paid', 'invoice_amount')} AS eff,
        CASE WHEN outstanding_balance <= 0 AND payment_date IS NOT NULL AND payment_date <= due_date THEN 'Paid'
             WHEN outstanding_balance <= 0 AND payment_date IS NOT NULL THEN 'Paid Late'
             WHEN outstanding_balance > 0 THEN 'OverDue' ELSE 'Paid' END AS payment_status
      FROM {out}_settled WHERE nth = 1))
)"""


ACCOUNTS = f"{INVOICES}, {clean_invoices('invoices', 'invoice_number', 'accounts')}"
RAW_ACCOUNTS = f"""{INVOICES},
raw_accounts AS (
  SELECT customer_id || '-' || strftime(invoice_date, '%Y-%m') AS transaction_id, {iso('invoice_date')} AS invoice_date,
    year, month, month_name, quarter, customer_id, customer_name, customer_type, invoice_number,
    CASE WHEN priority = '5-LOW' THEN 'unknown' ELSE {iso('due_date')} END AS due_date, invoice_amount,
    CAST(CASE WHEN priority = '2-HIGH' AND amount_paid > 0 THEN round(amount_paid * CAST('1.05' AS DECIMAL(3,2)), 2)
         ELSE amount_paid END AS VARCHAR) AS amount_paid,
    CAST(CASE WHEN priority = '1-URGENT' THEN invoice_amount ELSE outstanding_balance END AS VARCHAR) AS outstanding_balance,
    payment_date, CAST(NULL AS VARCHAR) AS payment_status, credit_days, priority
  FROM invoices
)"""
CLEAN_ACCOUNTS = f"{RAW_ACCOUNTS}, {clean_invoices('raw_accounts', 'invoice_date, invoice_number', 'cleaned')}"


def with_(*parts: str) -> str:
    """``with_(SALES, body)``: common table expressions followed by the query."""
    *ctes, body = parts
    return "WITH " + ",".join(ctes) + "\n" + body
