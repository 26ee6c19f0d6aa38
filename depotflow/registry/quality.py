"""Data-quality reports of the untidy tables."""

from __future__ import annotations

from depotflow import contracts
from depotflow.contracts import TableContract
from depotflow.plans.quality import quality_report, quality_summary
from depotflow.registry.base import query
from depotflow.registry.sqltext import (
    NUM,
    RAW_ACCOUNTS,
    RAW_INVENTORY,
    RAW_RUNS,
    RAW_SALES,
    pct,
    with_,
)


def _report_sql(table: str, contract: TableContract, absent=(), extra=()) -> str:
    """One SELECT per report line, each over the whole raw table."""
    present = [c for c in contract.columns if c not in absent]
    total = f"(SELECT count(*) FROM {table})"

    def line(check, column, level, bad, passed, low="NULL", high="NULL"):
        return f"""SELECT '{contract.name}' AS table_name, '{check}' AS check_name, '{column}' AS column_name,
          CASE WHEN bad > 0 THEN '{level}' ELSE 'INFO' END AS severity, CAST(bad AS BIGINT) AS bad_count,
          CAST(low AS VARCHAR) AS min_value, CAST(high AS VARCHAR) AS max_value, {passed} AS passed,
          coalesce({pct('bad', total)}, 0) AS bad_pct
        FROM (SELECT {bad} AS bad, {low} AS low, {high} AS high FROM {table})"""

    def missing(expr):
        return f"count(*) FILTER (WHERE {expr})"

    lines = [line("required_column", c, "ERROR", "max(1)", "false") for c in absent]
    lines.append(line("required_columns", "*", "ERROR", f"max({len(absent)})", "bad = 0"))
    lines.append(
        line("row_count", "*", "WARNING", f"greatest({contract.min_rows} - count(*), 0)", "bad = 0", "count(*)")
    )
    for c in [*present, *extra]:
        needed = c in contract.required_values
        lines.append(
            line("nulls", c, "ERROR" if needed else "INFO", missing(f'"{c}" IS NULL'),
                 "bad = 0" if needed else "true")
        )
    for c in contract.of_kind("date"):
        when = f'TRY_CAST("{c}" AS TIMESTAMP)'
        lines.append(
            line("dates", c, "WARNING", missing(f'"{c}" IS NOT NULL AND {when} IS NULL'), "bad = 0",
                 f"CAST(min({when}) AS DATE)", f"CAST(max({when}) AS DATE)")
        )
    for c in contract.of_kind("number"):
        value = f'TRY_CAST("{c}" AS {NUM})'
        for check, bad in (("numbers", f'"{c}" IS NOT NULL AND {value} IS NULL'), ("negatives", f"{value} < 0")):
            lines.append(line(check, c, "WARNING", missing(bad), "bad = 0", f"min({value})", f"max({value})"))
    key = contract.id_column
    lines.append(
        line("duplicates", key, "WARNING",
             f"count(*) - count(DISTINCT {key}) - CASE WHEN count(*) > count({key}) THEN 1 ELSE 0 END", "bad = 0")
    )
    return "\nUNION ALL ".join(lines)


_SALES = _report_sql("raw_sales", contracts.SALES)
_RUNS = _report_sql("raw_production", contracts.PRODUCTION)
_STOCK = _report_sql("raw_inventory", contracts.INVENTORY)
_INVOICES = _report_sql(
    "raw_accounts", contracts.ACCOUNTS, absent=("days_to_payment",), extra=("priority",)
)


@query("quality_sales", with_(RAW_SALES, _SALES))
def _(t):
    return quality_report(t.raw_sales(), contracts.SALES)


@query("quality_sales_one_pass", with_(RAW_SALES, _SALES))
def _(t):
    return quality_report(t.raw_sales(), contracts.SALES, one_pass=True)


@query("quality_accounts_one_pass", with_(RAW_ACCOUNTS, _INVOICES))
def _(t):
    """Ids repeat, and one column is missing."""
    return quality_report(t.raw_accounts(), contracts.ACCOUNTS, one_pass=True)


@query("quality_production", with_(RAW_RUNS, _RUNS))
def _(t):
    return quality_report(t.raw_production(), contracts.PRODUCTION)


@query("quality_inventory", with_(RAW_INVENTORY, _STOCK))
def _(t):
    return quality_report(t.raw_inventory(), contracts.INVENTORY)


@query("quality_accounts", with_(RAW_ACCOUNTS, _INVOICES))
def _(t):
    return quality_report(t.raw_accounts(), contracts.ACCOUNTS)


@query(
    "quality_summary",
    with_(
        RAW_SALES,
        RAW_RUNS,
        RAW_INVENTORY,
        RAW_ACCOUNTS,
        "\nreport AS (" + "\nUNION ALL ".join((_SALES, _RUNS, _STOCK, _INVOICES)) + ")",
        """SELECT table_name, count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed_checks,
          true AS ingested FROM report GROUP BY 1""",
    ),
)
def _(t):
    return quality_summary(
        {
            "sales": quality_report(t.raw_sales(), contracts.SALES),
            "production": quality_report(t.raw_production(), contracts.PRODUCTION),
            "inventory": quality_report(t.raw_inventory(), contracts.INVENTORY),
            "accounts": quality_report(t.raw_accounts(), contracts.ACCOUNTS),
        }
    )
