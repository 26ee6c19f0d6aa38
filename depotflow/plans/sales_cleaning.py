"""Sales cleaning job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from depotflow.functions.calendar import day_name, financial_year, is_weekend
from depotflow.functions.numeric import percent, right_closed_bin
from depotflow.functions.text import is_member, title_case
from depotflow.operators.dedup import keep_first
from depotflow.plans.dimensions import ROUTES
from depotflow.plans.cleaning import (
    CATEGORIES,
    END,
    START,
    Finding,
    any_set_aside,
    delivered,
    finding_counts,
    finding_rows,
    flagged,
    parsed,
    without_missing,
)

MEASURES = ("quantity", "unit_price", "gross_amount", "discount", "net_amount")

# Revenue bands, right-closed.
BAND_EDGES = (0, 500, 2000, 5000, 10000, None)
BAND_LABELS = ("<500", "500-2K", "2K-5K", "5K-10K", "10K+")


@dataclass(frozen=True)
class SalesRules:
    # The accepted members of each text column.
    categories: frozenset[str] = CATEGORIES
    payment_modes: frozenset[str] = frozenset({"Cash", "Credit", "UPI", "Cheque"})
    customer_types: frozenset[str] = frozenset(
        {"Retailer", "Wholesaler", "Hotel/Restaurant", "Institutional", "Direct Consumer"}
    )
    routes: frozenset[str] = frozenset(name for _, name, *_ in ROUTES)
    start: dt.date = START
    end: dt.date = END
    date_formats: tuple[str, ...] = ()


def usable_sales(raw: DataFrame, rules: SalesRules) -> DataFrame:
    """Parsed rows inside the date window that have quantity, price and net amount."""
    rows = parsed(raw, MEASURES, ["date"], "date", rules.start, rules.end, rules.date_formats)
    return without_missing(rows, ["quantity", "unit_price", "net_amount"])


def flagged_sales(raw: DataFrame, rules: SalesRules) -> DataFrame:
    """Every raw row, parsed, with the reason that drops it."""
    needed = ["quantity", "unit_price", "net_amount"]
    return flagged(raw, MEASURES, ["date"], "date", rules.start, rules.end, needed, rules.date_formats)


def _standardised(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {c: title_case(F.col(c)) for c in ("category", "customer_type", "route_name")}
    )


def _quality_flag(rules: SalesRules):
    """The most severe finding wins; a later measure outranks an earlier one."""
    flag = F.when(any_set_aside(), "NUMBER_SET_ASIDE")
    flag = flag.when(F.col("net_amount") <= 0, "ZERO_OR_NEGATIVE_NET")
    for name in reversed(MEASURES):
        flag = flag.when(F.col(name) < 0, f"NEGATIVE_{name.upper()}")
    return flag.when(
        ~is_member(F.col("category"), rules.categories), "INVALID_CATEGORY"
    ).otherwise("OK")


def clean_sales(
    raw: DataFrame,
    order: Sequence,
    rules: SalesRules = SalesRules(),
    keep_set_aside: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """Cleaned sales lines; ``order`` decides which copy of a sale id is the first.

    A line with a number too large for the decimal stays, flagged; ``keep_set_aside`` delivers its text.
    ``within`` names columns by which ``raw`` lies together already: copies are then removed among rows that
    share these, without an exchange, and ``store_star`` has to settle those that do not.

    Copies are removed before the text and derived columns are computed, so neither
    travels through the exchange.
    """
    rows = keep_first(usable_sales(raw, rules), [*within, "sale_id"], order)
    rows = _standardised(rows)
    day = F.col("date").cast("date")
    rows = rows.withColumns(
        {
            "date": day,
            "data_quality_flag": _quality_flag(rules),
            "day_of_week": day_name(day),
            "is_weekend": is_weekend(day),
            "financial_year": financial_year(day),
            "revenue_band": right_closed_bin(F.col("net_amount"), BAND_EDGES, BAND_LABELS),
        }
    )
    return delivered(rows, keep_set_aside)


def sales_findings(rules: SalesRules) -> dict[str, Finding]:
    """The business rules of usable sales rows."""
    gross, net, discount = F.col("gross_amount"), F.col("net_amount"), F.col("discount")
    expected = F.round(F.col("quantity") * F.col("unit_price"), 2)
    off_by = F.abs(gross - expected).cast("double") / F.nullif(
        expected.cast("double"), F.lit(0.0)
    )
    share, rest = percent(discount, gross), F.round(gross - discount, 2)

    def member(name: str, allowed) -> Finding:
        return Finding(~is_member(F.col(name), allowed), text=F.col(name))

    return {
        "invalid_category": member("category", rules.categories),
        "invalid_payment_mode": member("payment_mode", rules.payment_modes),
        "invalid_customer_type": member("customer_type", rules.customer_types),
        "invalid_route": member("route_name", rules.routes),
        "gross_not_quantity_times_price": Finding(off_by > 0.01, value=gross, expected=expected),
        "net_not_gross_less_discount": Finding(F.abs(net - rest) > 1, value=net, expected=rest),
        "discount_above_20_percent": Finding(share > 20, value=share, expected=F.lit(20)),
        "net_not_positive": Finding(net <= 0, value=net, expected=F.lit(0)),
        **{
            f"negative_{m}": Finding(F.col(m) < 0, value=F.col(m), expected=F.lit(0))
            for m in MEASURES
        },
    }


def sales_rule_counts(raw: DataFrame, rules: SalesRules = SalesRules()) -> DataFrame:
    """One row: how many usable rows break each business rule (copies included)."""
    return finding_counts(_standardised(usable_sales(raw, rules)), sales_findings(rules))


def sales_rule_violations(raw: DataFrame, rules: SalesRules = SalesRules()) -> DataFrame:
    """The usable rows (copies included) behind the counts, one row for each rule broken."""
    return finding_rows(_standardised(usable_sales(raw, rules)), "sale_id", sales_findings(rules))
