"""Receivables cleaning job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.calendar import financial_year
from depotflow.functions.numeric import cap_at, floor_at_zero, ladder_up, percent
from depotflow.operators.dedup import keep_first
from depotflow.plans.cleaning import (
    END,
    START,
    Finding,
    any_row,
    any_set_aside,
    delivered,
    finding_counts,
    finding_rows,
    flagged,
    parsed,
    without_missing,
)

MEASURES = ("invoice_amount", "amount_paid", "outstanding_balance", "credit_days")
DATES = ("invoice_date", "due_date", "payment_date")


@dataclass(frozen=True)
class AccountsRules:
    start: dt.date = START
    end: dt.date = END
    analysis_date: dt.date = END
    correction_scope: str = "dataset"
    date_formats: tuple[str, ...] = ()


def flagged_accounts(raw: DataFrame, rules: AccountsRules) -> DataFrame:
    """Every raw invoice, parsed, with the reason that drops it."""
    return flagged(
        raw, MEASURES, DATES, "invoice_date", rules.start, rules.end, ["invoice_amount"], rules.date_formats
    )


def usable_accounts(raw: DataFrame, rules: AccountsRules) -> DataFrame:
    """Parsed invoices with an amount; a missing payment date is valid (unpaid)."""
    rows = parsed(
        raw, MEASURES, DATES, "invoice_date", rules.start, rules.end, rules.date_formats
    )
    return without_missing(rows, ["invoice_amount"])


def accounts_triggers() -> dict[str, Column]:
    """What switches a correction on."""
    invoiced, paid, open_ = (F.col(c) for c in MEASURES[:3])
    gap = F.round(invoiced - paid, 2)
    return {"balance": F.abs(open_ - gap) > 1, "overpaid": paid > invoiced}


def reconciled(
    rows: DataFrame, scope: str, triggers: DataFrame | None = None, off: dict[str, Column] | None = None
) -> DataFrame:
    """Enforce outstanding = invoiced - paid (never below zero) and paid <= invoiced.

    ``triggers`` holds the amounts of the same invoices where a cheaper source than
    ``rows`` has them (no joins); ``off`` has the triggers themselves where they are known.
    """
    invoiced, paid, open_ = (F.col(c) for c in MEASURES[:3])
    gap = F.round(invoiced - paid, 2)
    if off is None:
        off = any_row(rows if triggers is None else triggers, accounts_triggers(), scope)
    capped = cap_at(paid, invoiced)
    return rows.withColumns(
        {
            "outstanding_balance": F.when(off["overpaid"], floor_at_zero(invoiced - capped))
            .when(off["balance"], floor_at_zero(gap))
            .otherwise(open_),
            "amount_paid": F.when(off["overpaid"], capped).otherwise(paid),
        }
    )


def payment_status(open_: Column, paid_on: Column, due: Column) -> Column:
    settled = (open_ <= 0) & paid_on.isNotNull()
    in_time = F.coalesce(paid_on <= due, F.lit(False))
    return (
        F.when(settled & in_time, "Paid")
        .when(settled, "Paid Late")
        .when(open_ > 0, "OverDue")
        .otherwise("Paid")
    )


def aging_bucket(status: Column, days: Column) -> Column:
    """30-day buckets of overdue invoices; an unknown age counts as the oldest."""
    steps = [(30, "1-30 Days"), (60, "31-60 Days"), (90, "61-90 Days")]
    return F.when(status != "OverDue", "Not OverDue").otherwise(
        ladder_up(days, steps, "90+ Days")
    )


def clean_accounts(
    raw: DataFrame,
    order: Sequence,
    rules: AccountsRules = AccountsRules(),
    amounts: DataFrame | None = None,
    keep_set_aside: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """Cleaned invoices with status, age, collection efficiency and days to payment.

    ``amounts``: the same raw invoices without joined attributes, for the dataset-wide
    triggers; ``raw`` itself where omitted.  Status and age are null where a number set aside leaves the
    open balance unknown.  ``within`` as for ``clean_sales``.
    """
    triggers = None if amounts is None else usable_accounts(amounts, rules)
    rows = reconciled(usable_accounts(raw, rules), rules.correction_scope, triggers)
    return delivered(accounts_derived(keep_first(rows, [*within, "transaction_id"], order), rules), keep_set_aside)


def accounts_derived(rows: DataFrame, rules: AccountsRules) -> DataFrame:
    """Status, age, efficiency and days to payment of reconciled invoices, one of each id."""
    open_, unknown = F.col("outstanding_balance"), any_set_aside() & F.col("outstanding_balance").isNull()
    status = payment_status(open_, F.col("payment_date"), F.col("due_date"))
    rows = rows.withColumn("payment_status", F.when(unknown, F.lit(None)).otherwise(status))
    # Whole elapsed days: both ends are moments, so a part of a day does not count.
    late = _days_between(F.lit(str(rules.analysis_date)).cast("timestamp_ntz"), F.col("due_date"))
    efficiency = percent(F.col("amount_paid"), F.col("invoice_amount"))
    rows = rows.withColumns(
        {
            "financial_year": financial_year(F.col("invoice_date")),
            "days_overdue": F.when(
                F.col("payment_status") == "OverDue", F.when(late < 0, 0).otherwise(late)
            )
            .when(unknown, F.lit(None))
            .otherwise(0),
            "collection_efficiency_pct": F.when(efficiency < 0, 0)
            .when(efficiency > 100, 100)
            .otherwise(efficiency),
            "days_to_payment": _days_between(F.col("payment_date"), F.col("invoice_date")),
        }
    )
    rows = rows.withColumn(
        "aging_bucket",
        F.when(unknown, F.lit(None)).otherwise(aging_bucket(F.col("payment_status"), F.col("days_overdue"))),
    )
    return rows.withColumns({d: F.col(d).cast("date") for d in DATES})


def _days_between(end: Column, start: Column) -> Column:
    """Whole elapsed days between zone-free moments (no session time zone involved)."""

    def time_of_day(moment: Column) -> Column:
        return moment - moment.cast("date").cast("timestamp_ntz")

    begun = F.when(time_of_day(end) < time_of_day(start), 1).otherwise(0)
    return F.date_diff(end.cast("date"), start.cast("date")) - begun


def accounts_findings() -> dict[str, Finding]:
    """The business rules of usable invoices."""
    invoiced, paid, open_ = (F.col(c) for c in MEASURES[:3])
    gap = F.round(invoiced - paid, 2)
    return {
        "balance_not_reconciled": Finding(F.abs(open_ - gap) > 1, value=open_, expected=gap),
        "overpaid": Finding(paid > invoiced, value=paid, expected=invoiced),
        "no_payment_date": Finding(F.col("payment_date").isNull()),
    }


def accounts_rule_counts(
    raw: DataFrame, rules: AccountsRules = AccountsRules()
) -> DataFrame:
    return finding_counts(usable_accounts(raw, rules), accounts_findings())


def accounts_rule_violations(
    raw: DataFrame, rules: AccountsRules = AccountsRules()
) -> DataFrame:
    """The usable invoices behind the counts, one row for each rule broken."""
    return finding_rows(usable_accounts(raw, rules), "transaction_id", accounts_findings())
