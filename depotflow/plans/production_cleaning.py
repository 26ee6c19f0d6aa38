"""Production cleaning job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from depotflow.functions.calendar import day_name, financial_year
from depotflow.functions.numeric import floor_at_zero, percent, right_closed_bin
from depotflow.functions.text import is_member, title_case
from depotflow.operators.dedup import keep_first
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

QUANTITIES = ("planned_qty", "actual_qty", "wastage_qty", "net_produced_qty")
MEASURES = (*QUANTITIES, "raw_milk_used_L", "production_efficiency_%", "wastage_rate_%")

# Column names of the star table (the raw names carry '%' and upper case).
STAR_NAMES = {
    "raw_milk_used_L": "raw_milk_used_l",
    "production_efficiency_%": "production_efficiency_pct",
    "wastage_rate_%": "wastage_rate_pct",
}

# Efficiency bands, right-closed.
BAND_EDGES = (0, 85, 90, 95, 100, 110)
BAND_LABELS = (
    "Critical (<85%)",
    "Poor (85-90%)",
    "Fair (90-95%)",
    "Good (95-100%)",
    "Excellent (>100%)",
)


@dataclass(frozen=True)
class ProductionRules:
    categories: frozenset[str] = CATEGORIES
    shifts: frozenset[str] = frozenset({"Morning", "Evening"})
    start: dt.date = START
    end: dt.date = END
    date_formats: tuple[str, ...] = ()


def usable_production(raw: DataFrame, rules: ProductionRules) -> DataFrame:
    """Parsed runs with a plan and an actual quantity, negatives raised to zero."""
    rows = parsed(raw, MEASURES, ["date"], "date", rules.start, rules.end, rules.date_formats)
    rows = without_missing(rows, ["planned_qty", "actual_qty"])
    return rows.withColumns({q: floor_at_zero(F.col(q)) for q in QUANTITIES})


def flagged_production(raw: DataFrame, rules: ProductionRules) -> DataFrame:
    """Every raw run, parsed, with the reason that drops it."""
    needed = ["planned_qty", "actual_qty"]
    rows = flagged(raw, MEASURES, ["date"], "date", rules.start, rules.end, needed, rules.date_formats)
    return rows.withColumns({q: floor_at_zero(F.col(q)) for q in QUANTITIES})


def clean_production(
    raw: DataFrame, order: Sequence, rules: ProductionRules = ProductionRules(), keep_set_aside: bool = False
) -> DataFrame:
    """Cleaned production runs under their star-table column names.

    An unknown category or shift leaves no mark in the flag: it is reported by
    ``production_rule_counts`` only.
    """
    rows = production_derived(keep_first(usable_production(raw, rules), ["production_id"], order))
    return delivered(rows, keep_set_aside)


def production_derived(rows: DataFrame) -> DataFrame:
    """Star names and derived columns of usable runs, one of each id."""
    rows = rows.withColumnsRenamed(STAR_NAMES)
    day = F.col("date").cast("date")
    planned, actual, wasted = (F.col(q) for q in QUANTITIES[:3])
    rows = rows.withColumns(
        {
            "date": day,
            "category": title_case(F.col("category")),
            "shift": title_case(F.col("shift")),
            "wastage_qty": F.when(wasted > actual, F.lit(0)).otherwise(wasted),
        }
    )
    rows = rows.withColumns(
        {
            "net_produced_qty": F.col("actual_qty") - F.col("wastage_qty"),
            "production_efficiency_pct": percent(actual, planned),
            "wastage_rate_pct": percent(F.col("wastage_qty"), actual),
        }
    )
    efficiency, waste = F.col("production_efficiency_pct"), F.col("wastage_rate_pct")
    return rows.withColumns(
        {
            "day_of_week": day_name(day),
            "financial_year": financial_year(day),
            "efficiency_band": right_closed_bin(efficiency, BAND_EDGES, BAND_LABELS),
            "data_quality_flag": F.when(any_set_aside(), "NUMBER_SET_ASIDE")
            .when(waste > 10, "HIGH_WASTAGE")
            .when(efficiency > 110, "OVER_PRODUCTION")
            .otherwise("OK"),
        }
    )


def production_findings(rules: ProductionRules) -> dict[str, Finding]:
    """The business rules of usable runs."""
    category, shift = title_case(F.col("category")), title_case(F.col("shift"))
    actual, wasted = F.col("actual_qty"), F.col("wastage_qty")
    most = F.col("planned_qty") * F.lit("1.10").cast("decimal(3,2)")
    return {
        "invalid_category": Finding(~is_member(category, rules.categories), text=category),
        "invalid_shift": Finding(~is_member(shift, rules.shifts), text=shift),
        "over_production": Finding(actual > most, value=actual, expected=most),
        "wastage_above_actual": Finding(wasted > actual, value=wasted, expected=actual),
    }


def production_rule_counts(
    raw: DataFrame, rules: ProductionRules = ProductionRules()
) -> DataFrame:
    """One row: how many usable runs break each rule (copies included)."""
    return finding_counts(usable_production(raw, rules), production_findings(rules))


def production_rule_violations(
    raw: DataFrame, rules: ProductionRules = ProductionRules()
) -> DataFrame:
    """The usable runs (copies included) behind the counts, one row for each rule broken."""
    return finding_rows(usable_production(raw, rules), "production_id", production_findings(rules))
