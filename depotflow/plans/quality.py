"""Structural data quality as one report table per raw table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.contracts import TableContract
from depotflow.functions.numeric import NUMBER, percent
from depotflow.operators.rollup import rollup
from depotflow.plans.accounts_cleaning import (
    DATES,
    MEASURES as ACCOUNT_MEASURES,
    AccountsRules,
    accounts_derived,
    accounts_triggers,
    flagged_accounts,
    reconciled,
)
from depotflow.plans.cleaning import DROPPED, SET_ASIDE, any_row, first_of_each
from depotflow.plans.inventory_cleaning import (
    MEASURES as STOCK_MEASURES,
    InventoryRules,
    balanced,
    flagged_inventory,
    inventory_derived,
    inventory_triggers,
)
from depotflow.plans.production_cleaning import (
    QUANTITIES,
    ProductionRules,
    flagged_production,
    production_derived,
)
from depotflow.plans.sales_cleaning import SalesRules, flagged_sales
from depotflow.session import stored


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _line(
    check: str, column: str, level: str, bad: str, passed: str,
    low: str = "cast(null as string)", high: str = "cast(null as string)",
) -> str:
    """SQL text of one report line; ``level`` applies when anything bad was counted."""
    shown = column.replace("\\", "\\\\").replace("'", "\\'")
    return (
        f"named_struct('check_name', '{check}', 'column_name', '{shown}', "
        f"'severity', if({bad} > 0, '{level}', 'INFO'), 'bad_count', cast({bad} as bigint), "
        f"'min_value', {low}, 'max_value', {high}, 'passed', {passed})"
    )


def quality_report(df: DataFrame, contract: TableContract, one_pass: bool = False) -> DataFrame:
    """All checks of one table: required columns, row count, nulls, duplicate ids, dates
    and numbers.

    Numbers too large for the decimal have a line (``set_aside``) in columns that hold any.

    Every check except duplicates is part of a single aggregate over one scan, whose
    tasks emit one row each.  Duplicates count rows per id, combined on the map side, in a
    second run of ``df`` that reads the id alone.

    ``one_pass`` runs ``df`` once: the same states (nulls, bad values, least and greatest) are
    kept per id together with the distinct count, and merged.  That shuffles a state as wide
    as the report for every id, so it pays where ``df`` is dear to run or ids repeat often; over
    Parquet files with unique ids the second, narrow run is cheaper.
    """
    columns = df.columns
    absent = [c for c in contract.columns if c not in columns]
    dates = [c for c in contract.of_kind("date") if c in columns]
    numbers = [c for c in contract.of_kind("number") if c in columns]

    def moment(c: str) -> str:
        tries = [f"try_cast({_name(c)} AS timestamp_ntz)"]
        tries += [
            f"cast(try_to_timestamp({_name(c)}, '{f}') AS timestamp_ntz)" for f in contract.date_formats
        ]
        return f"coalesce({', '.join(tries)})"

    def number(c: str) -> str:
        return f"try_cast({_name(c)} AS {NUMBER})"

    def no_number(c: str) -> str:
        """Neither this decimal nor any other number: too large a number is not a bad one."""
        wide = f"try_cast({_name(c)} AS double)"
        return f"{number(c)} IS NULL AND ({wide} IS NULL OR isnan({wide}))"

    def too_large(c: str) -> str:
        wide = f"try_cast({_name(c)} AS double)"
        return f"{number(c)} IS NULL AND abs({wide}) < double('Infinity')"

    stats = ["count(1) AS n"]
    stats += [f"count_if({_name(c)} IS NULL) AS {_name('null:' + c)}" for c in columns]
    parsed = [(c, f"cast({moment(c)} AS date)", f"{moment(c)} IS NULL") for c in dates]
    parsed += [(c, number(c), no_number(c)) for c in numbers]
    for c, shown, bad in parsed:
        stats += [
            f"count_if({_name(c)} IS NOT NULL AND {bad}) AS {_name('bad:' + c)}",
            f"cast(min({shown}) AS string) AS {_name('min:' + c)}",
            f"cast(max({shown}) AS string) AS {_name('max:' + c)}",
        ]
    stats += [f"count_if({number(c)} < 0) AS {_name('neg:' + c)}" for c in numbers]
    stats += [f"count_if({too_large(c)}) AS {_name('aside:' + c)}" for c in numbers]
    key = contract.id_column
    if one_pass and key in columns:
        # Rows without an id are copies of each other.
        stats.append(f"count(1) - count(DISTINCT {_name(key)}) - if(count_if({_name(key)} IS NULL) > 0, 1, 0) AS duplicates")
    one = df.agg(*[F.expr(s) for s in stats])

    lines = [_line("required_column", c, "ERROR", "1", "false") for c in absent]
    lines.append(
        _line("required_columns", "*", "ERROR", str(len(absent)), str(not absent).lower())
    )
    lacking = f"greatest({contract.min_rows} - n, 0)"
    lines.append(
        _line("row_count", "*", "WARNING", lacking, f"{lacking} = 0", low="cast(n AS string)")
    )
    for c in columns:
        nulls, needed = _name("null:" + c), c in contract.required_values
        lines.append(
            _line("nulls", c, "ERROR" if needed else "INFO", nulls, f"{nulls} = 0" if needed else "true")
        )
    checks = [("dates", "bad:", dates), ("numbers", "bad:", numbers), ("negatives", "neg:", numbers)]
    for c in numbers:
        aside = _name("aside:" + c)
        lines.append(_line("set_aside", c, "WARNING", aside, f"{aside} = 0"))
    for check, prefix, cols in checks:
        for c in cols:
            bad = _name(prefix + c)
            lines.append(
                _line(check, c, "WARNING", bad, f"{bad} = 0", _name("min:" + c), _name("max:" + c))
            )
    if key in columns:
        if not one_pass:
            ids = df.groupBy(F.col(_name(key)).alias("id")).agg(F.count(F.lit(1)).alias("n"))
            extra = ids.agg(F.sum(F.col("n") - 1)).scalar()
            one = one.withColumn("duplicates", F.coalesce(extra, F.lit(0)))
        lines.append(_line("duplicates", key, "WARNING", "duplicates", "duplicates = 0"))
    report = one.selectExpr(
        f"'{contract.name}' AS table_name", "n AS _n",
        f"inline(filter(array({', '.join(lines)}), x -> x.check_name != 'set_aside' OR x.bad_count > 0))",
    )
    share = F.coalesce(percent(F.col("bad_count"), F.col("_n")), F.lit(0))
    return report.withColumn("bad_pct", share).drop("_n")


def quality_summary(reports: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per table: checks, failed checks and whether the table was read.

    A failed check never fails the run; it is counted.  A table that is absent (None) has
    no checks and is not ingested.  At least one table must be there.
    """
    present = [report for report in reports.values() if report is not None]
    union = present[0]
    for report in present[1:]:
        union = union.unionByName(report)
    out = rollup(
        union.withColumn("_failed", F.when(F.col("passed"), 0).otherwise(1)),
        ["table_name"],
        {"checks": ("rows",), "failed_checks": ("sum", "_failed")},
    ).withColumn("ingested", F.lit(True))
    absent = [(name,) for name, report in reports.items() if report is None]
    if not absent:
        return out
    rows = union.sparkSession.createDataFrame(absent, "table_name string")
    return out.unionByName(
        rows.withColumns({"checks": F.lit(0), "failed_checks": F.lit(0), "ingested": F.lit(False)})
    )


def _tallies(folded: DataFrame) -> dict[str, Column]:
    """Rows in, out and dropped, by reason, of a fold by id."""
    dropped = {f"dropped_{r}": F.sum(f"dropped_{r}") for r in DROPPED}
    gone = sum(dropped.values(), F.lit(0))
    kept = F.sum("kept")
    return {"output_rows": kept, "input_rows": kept + gone, "dropped_rows": gone, **dropped}


def _one_row(out: DataFrame) -> DataFrame:
    """Counts of an empty table are zero."""
    counted = ["output_rows", "input_rows", "dropped_rows", *(f"dropped_{r}" for r in DROPPED)]
    return out.fillna(0, counted)


def sales_cleaning_summary(
    raw: DataFrame, order: Sequence[str], rules: SalesRules = SalesRules()
) -> DataFrame:
    """Rows in, out and dropped by reason, and totals of the cleaned rows, from one run of ``raw``."""
    columns = ["date", "net_amount", "customer_id", "product_id"]
    folded = first_of_each(flagged_sales(raw, rules), "sale_id", order, columns)
    sums = {"output_rows": "kept"} | {f"dropped_{r}": f"dropped_{r}" for r in DROPPED}
    out = rollup(
        folded.withColumn("_all", F.lit(1)),
        ["_all"],
        {
            **{name: ("sum", column) for name, column in sums.items()},
            "first_date": ("min", "date"),
            "last_date": ("max", "date"),
            "total_net_revenue": ("sum", "net_amount"),
            "unique_customers": ("distinct", "customer_id"),
            "unique_products": ("distinct", "product_id"),
        },
    ).drop("_all")
    gone = sum((F.col(f"dropped_{r}") for r in DROPPED), F.lit(0))
    out = out.withColumns({c: F.col(c).cast("date") for c in ("first_date", "last_date")})
    return out.withColumns({"dropped_rows": gone, "input_rows": gone + F.col("output_rows")})


def production_cleaning_summary(
    raw: DataFrame, order: Sequence[str], rules: ProductionRules = ProductionRules()
) -> DataFrame:
    columns = ["date", "category", "shift", *QUANTITIES, "raw_milk_used_L", SET_ASIDE]
    folded = first_of_each(flagged_production(raw, rules), "production_id", order, columns)
    cleaned = production_derived(folded)
    mean = {
        n: F.round((F.sum(c) / F.count(c)).cast("decimal(38,8)"), 2)
        for n, c in (
            ("avg_efficiency_pct", "production_efficiency_pct"),
            ("avg_wastage_pct", "wastage_rate_pct"),
        )
    }
    tallies = _tallies(folded) | mean | {"total_raw_milk_l": F.sum("raw_milk_used_l")}
    return _one_row(cleaned.agg(*[c.alias(n) for n, c in tallies.items()]))


def _any_of(folded: DataFrame, triggers: Mapping[str, Column], scope: str) -> Mapping[str, Column] | None:
    """Triggers of the whole table from those of its ids; by row they are evaluated anew."""
    return any_row(folded, {n: F.col(n) for n in triggers}, scope) if scope == "dataset" else None


def inventory_cleaning_summary(
    raw: DataFrame, order: Sequence[str], rules: InventoryRules = InventoryRules()
) -> DataFrame:
    """As for sales.  The fold carries the dataset-wide triggers, and is stored: triggers, means and totals
    read it, not ``raw`` again."""
    triggers = inventory_triggers()
    columns = ["date", "product_id", "category", *STOCK_MEASURES, SET_ASIDE]
    rows = flagged_inventory(raw, rules)
    folded = stored(first_of_each(rows, "inventory_id", order, columns, triggers))
    kept = folded.where("kept = 1").drop("kept", *(f"dropped_{r}" for r in DROPPED))
    scope = rules.correction_scope
    cleaned = inventory_derived(balanced(kept, scope, _any_of(folded, triggers, scope)), rules)
    out = cleaned.agg(
        *[
            F.count_if(F.col("stock_status") == s).alias(f"{s.lower()}_rows")
            for s in ("Stockout", "Critical", "Low", "OK")
        ],
        F.count_if(F.col("shelf_life_risk") == "At Risk").alias("shelf_life_at_risk"),
    )
    return _with_tallies(folded, out)


def accounts_cleaning_summary(
    raw: DataFrame, order: Sequence[str], rules: AccountsRules = AccountsRules()
) -> DataFrame:
    """As for stock: one run of ``raw``, whose fold is stored."""
    triggers = accounts_triggers()
    columns = [*DATES, *ACCOUNT_MEASURES, SET_ASIDE]
    rows = flagged_accounts(raw, rules)
    folded = stored(first_of_each(rows, "transaction_id", order, columns, triggers))
    kept = folded.where("kept = 1").drop("kept", *(f"dropped_{r}" for r in DROPPED))
    scope = rules.correction_scope
    cleaned = accounts_derived(reconciled(kept, scope, off=_any_of(folded, triggers, scope)), rules)
    status = F.col("payment_status")
    out = cleaned.agg(
        F.sum("invoice_amount").alias("total_billed"),
        F.sum("amount_paid").alias("total_collected"),
        F.sum("outstanding_balance").alias("total_outstanding"),
        percent(F.sum("amount_paid"), F.sum("invoice_amount")).alias("collection_efficiency_pct"),
        F.count_if(status == "Paid").alias("paid_invoices"),
        F.count_if(status == "Paid Late").alias("paid_late_invoices"),
        F.count_if(status == "OverDue").alias("overdue_invoices"),
        F.count_if(F.col("aging_bucket") == "90+ Days").alias("overdue_90_plus"),
    )
    return _with_tallies(folded, out)


def _with_tallies(folded: DataFrame, out: DataFrame) -> DataFrame:
    """Attach the counts of a stored fold to a one-row result."""
    names = list(_tallies(folded))
    counts = folded.agg(F.struct(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in _tallies(folded).items()]).alias("t"))
    counts = counts.scalar()
    return out.withColumns({n: counts.getField(n) for n in names})
