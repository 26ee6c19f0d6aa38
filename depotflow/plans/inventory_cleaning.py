"""Stock cleaning job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.calendar import day_name, financial_year
from depotflow.functions.numeric import cap_at, floor_at_zero, half_up
from depotflow.operators.dedup import keep_first
from depotflow.operators.joins import mean_per_group
from depotflow.plans.cleaning import (
    END,
    SHELF_LIFE_DAYS,
    START,
    Finding,
    any_row,
    any_set_aside,
    delivered,
    finding_counts,
    finding_rows,
    flagged,
    is_missing,
    parsed,
)

MEASURES = ("opening_stock", "received_qty", "dispatched_qty", "closing_stock", "reorder_level")


@dataclass(frozen=True)
class InventoryRules:
    shelf_life_days: Mapping[str, int] = field(default_factory=lambda: dict(SHELF_LIFE_DAYS))
    start: dt.date = START
    end: dt.date = END
    correction_scope: str = "dataset"
    date_formats: tuple[str, ...] = ()


def usable_inventory(raw: DataFrame, rules: InventoryRules) -> DataFrame:
    """Parsed stock rows; missing or negative quantities count as zero."""
    rows = parsed(raw, MEASURES, ["date"], "date", rules.start, rules.end, rules.date_formats)
    return _floored(rows)


def _floored(rows: DataFrame) -> DataFrame:
    # A number set aside stays unknown.
    known = {m: F.when(is_missing(m), F.lit(0)).otherwise(F.col(m)) for m in MEASURES}
    return rows.withColumns({m: floor_at_zero(c) for m, c in known.items()})


def flagged_inventory(raw: DataFrame, rules: InventoryRules) -> DataFrame:
    """Every raw stock row, parsed, with the reason that drops it."""
    rows = flagged(raw, MEASURES, ["date"], "date", rules.start, rules.end, [], rules.date_formats)
    return _floored(rows)


def inventory_triggers() -> dict[str, Column]:
    """What switches a correction on."""
    available = F.col("opening_stock") + F.col("received_qty")
    dispatched, closing = F.col("dispatched_qty"), F.col("closing_stock")
    return {
        "balance": F.abs(closing - (available - dispatched)) > 1,
        "over_dispatch": dispatched > available,
    }


def balanced(rows: DataFrame, scope: str, off: Mapping[str, Column] | None = None) -> DataFrame:
    """Enforce closing = opening + received - dispatched, never below zero, and never
    more dispatched than was available; ``off`` has the triggers where they are known."""
    available = F.col("opening_stock") + F.col("received_qty")
    dispatched, closing = F.col("dispatched_qty"), F.col("closing_stock")
    if off is None:
        off = any_row(rows, inventory_triggers(), scope)
    capped = cap_at(dispatched, available)
    return rows.withColumns(
        {
            "closing_stock": F.when(off["over_dispatch"], floor_at_zero(available - capped))
            .when(off["balance"], floor_at_zero(available - dispatched))
            .otherwise(closing),
            "dispatched_qty": F.when(off["over_dispatch"], capped).otherwise(dispatched),
        }
    )


def stock_status(closing: Column, reorder: Column) -> Column:
    return (
        F.when(closing == 0, "Stockout")
        .when(closing * 2 <= reorder, "Critical")
        .when(closing < reorder, "Low")
        .otherwise("OK")
    )


def shelf_life(category: Column, days: Mapping[str, int]) -> Column:
    """Days by category; unknown categories have none."""
    pairs = [F.lit(x) for kv in sorted(days.items()) for x in kv]
    return F.try_element_at(F.create_map(*pairs), category) if pairs else F.lit(None).cast("int")


def clean_inventory(
    raw: DataFrame, order: Sequence, rules: InventoryRules = InventoryRules(), keep_set_aside: bool = False
) -> DataFrame:
    """Cleaned stock rows with status, days of stock and shelf-life risk.

    Status and risk of a row are null where a number set aside leaves its stock unknown.
    """
    rows = balanced(usable_inventory(raw, rules), rules.correction_scope)
    return delivered(inventory_derived(keep_first(rows, ["inventory_id"], order), rules), keep_set_aside)


def inventory_derived(rows: DataFrame, rules: InventoryRules) -> DataFrame:
    """Status, days of stock and shelf-life risk of balanced rows, one of each id."""
    day, closing = F.col("date").cast("date"), F.col("closing_stock")
    unknown = any_set_aside() & (closing.isNull() | F.col("reorder_level").isNull())
    rows = rows.withColumns(
        {
            "date": day,
            "stock_status": F.when(unknown, F.lit(None)).otherwise(stock_status(closing, F.col("reorder_level"))),
            "financial_year": financial_year(day),
            "day_of_week": day_name(day),
            "shelf_life_days": shelf_life(F.col("category"), rules.shelf_life_days),
        }
    )
    rows = mean_per_group(rows, "product_id", "dispatched_qty", "_mean_dispatch", 1)
    mean = F.col("_mean_dispatch")
    cover = half_up(closing.cast("double") / mean.cast("double"), 1)
    rows = rows.withColumn(
        "days_of_stock", F.when(mean > 0, cover).otherwise(closing)
    )
    at_risk = F.coalesce(F.col("days_of_stock") > F.col("shelf_life_days"), F.lit(False))
    risk = F.when(at_risk, "At Risk").when(any_set_aside() & closing.isNull(), F.lit(None)).otherwise("Safe")
    return rows.withColumn("shelf_life_risk", risk).drop("_mean_dispatch")


def inventory_findings() -> dict[str, Finding]:
    """The business rules of usable stock rows."""
    available = F.col("opening_stock") + F.col("received_qty")
    dispatched, closing = F.col("dispatched_qty"), F.col("closing_stock")
    left = available - dispatched
    return {
        "closing_not_balanced": Finding(F.abs(closing - left) > 1, value=closing, expected=left),
        "over_dispatched": Finding(dispatched > available, value=dispatched, expected=available),
    }


def inventory_rule_counts(
    raw: DataFrame, rules: InventoryRules = InventoryRules()
) -> DataFrame:
    return finding_counts(usable_inventory(raw, rules), inventory_findings())


def inventory_rule_violations(
    raw: DataFrame, rules: InventoryRules = InventoryRules()
) -> DataFrame:
    """The usable stock rows behind the counts, one row for each rule broken."""
    return finding_rows(usable_inventory(raw, rules), "inventory_id", inventory_findings())
