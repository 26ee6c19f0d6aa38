"""Steps shared by the four cleaning jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from depotflow.functions.calendar import to_moment
from depotflow.functions.numeric import NUMBER, too_large
from depotflow.functions.text import strip_all

# Default analysis window (inclusive, at midnight).
START = dt.date(2023, 4, 1)
END = dt.date(2025, 3, 31)

# Product categories with their shelf life in days.
SHELF_LIFE_DAYS = {
    "Milk Bulk": 2,
    "Milk Packet": 3,
    "Paneer": 7,
    "Curd": 5,
    "Ghee": 180,
    "Butter": 90,
    "Cream": 10,
}
CATEGORIES = frozenset(SHELF_LIFE_DAYS)


#: Numbers of a row that the decimal cannot hold, as (column, text, reason); null where there are none.
SET_ASIDE = "set_aside"
_ASIDE = "array<struct<column: string, text: string, reason: string>>"


def parsed(
    df: DataFrame,
    numbers: Sequence[str],
    dates: Sequence[str],
    window_on: str,
    start: dt.date,
    end: dt.date,
    formats: tuple[str, ...] = (),
) -> DataFrame:
    """Strip text, coerce dates and numbers, keep rows whose date lies in the window.

    The window compares moments, not days: the last day counts at midnight only.  A number too large
    for the decimal becomes null and is kept in ``set_aside``: it is not missing.
    """
    df = strip_all(df)
    df = df.withColumns({d: to_moment(df, d, formats) for d in dates})
    low, high = (F.lit(str(d)).cast("timestamp_ntz") for d in (start, end))
    df = df.filter(F.col(window_on).between(low, high))
    return df.withColumns({n: _measure(df, n) for n in numbers} | {SET_ASIDE: set_aside(df, numbers)})


#: Why a raw row is not among the cleaned ones, in the order in which the rules apply.
DROPPED = ("bad_date", "outside_dates", "missing_value", "duplicate")


def flagged(
    df: DataFrame,
    numbers: Sequence[str],
    dates: Sequence[str],
    window_on: str,
    start: dt.date,
    end: dt.date,
    needed: Sequence[str],
    formats: tuple[str, ...] = (),
) -> DataFrame:
    """As ``parsed``, but every row stays and ``dropped_because`` says why the job drops it (null: usable).

    Copies of an id are not marked here: which one is the first is known only per id.
    """
    df = strip_all(df)
    df = df.withColumns({d: to_moment(df, d, formats) for d in dates})
    low, high = (F.lit(str(d)).cast("timestamp_ntz") for d in (start, end))
    inside = F.coalesce(F.col(window_on).between(low, high), F.lit(False))
    # Numbers of rows outside the window are not parsed, as they are not in ``parsed``.
    measures = {n: F.when(inside, _measure(df, n)) for n in numbers}
    df = df.withColumns(measures | {SET_ASIDE: F.when(inside, set_aside(df, numbers))})
    missing = F.lit(False)
    for name in needed:
        missing = missing | is_missing(name)
    why = F.when(F.col(window_on).isNull(), "bad_date").when(~inside, "outside_dates").when(missing, "missing_value")
    return df.withColumn("dropped_because", why)


def first_of_each(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    columns: Sequence[str],
    triggers: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fold ``flagged`` rows to one row per id, from one run of them.

    Kept are ``columns`` of the first usable copy under ``order`` (nulls first), ``kept`` (0 or 1), the
    rows dropped by reason as ``dropped_<reason>``, and whether any usable copy meets each of ``triggers``.
    The fold combines on the map side, so an id with a third of all rows sends one row per task.
    """
    usable = F.col("dropped_because").isNull()
    rank = F.when(usable, F.struct(*[F.col(c) for c in order]))
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    reasons = {r: F.count_if(F.col("dropped_because") == r).alias(f"dropped_{r}") for r in DROPPED[:-1]}
    met = {n: F.coalesce(F.bool_or(usable & c), F.lit(False)).alias(n) for n, c in (triggers or {}).items()}
    folded = rows.groupBy(F.col(key).alias("_id")).agg(
        F.min_by(whole, rank).alias("_first"), F.count_if(usable).alias("_usable"), *reasons.values(), *met.values()
    )
    return folded.select(
        *([F.col("_id").alias(key)] if key not in columns else []),
        "_first.*",
        F.least("_usable", F.lit(1)).alias("kept"),
        *[f"dropped_{r}" for r in reasons],
        F.greatest(F.col("_usable") - 1, F.lit(0)).alias("dropped_duplicate"),
        *met,
    )


def _measure(df: DataFrame, name: str) -> Column:
    """Text and doubles are parsed; decimals, and whole numbers as such, are exact already."""
    col, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return col
    return col.cast("decimal(20,0)") if isinstance(kind, T.IntegralType) else col.try_cast(NUMBER)


def set_aside(df: DataFrame, numbers: Sequence[str]) -> Column:
    """The ``numbers`` of a row that are too large; columns that are exact already have none."""
    exact = (T.DecimalType, T.IntegralType)
    loose = [n for n in numbers if not isinstance(df.schema[n].dataType, exact)]
    if not loose:
        return F.lit(None).cast(_ASIDE)
    large = {n: too_large(F.col(f"`{n}`")) for n in loose}
    found = [
        F.when(
            cond,
            F.struct(
                F.lit(n).alias("column"),
                F.col(f"`{n}`").cast("string").alias("text"),
                F.lit("too large").alias("reason"),
            ),
        )
        for n, cond in large.items()
    ]
    return F.when(reduce(or_, large.values()), F.array_compact(F.array(*found))).cast(_ASIDE)


def is_missing(name: str) -> Column:
    """A parsed number is absent, and was not set aside."""
    kept = F.coalesce(F.array_contains(F.col(f"{SET_ASIDE}.column"), name), F.lit(False))
    return F.col(f"`{name}`").isNull() & ~kept


def without_missing(rows: DataFrame, needed: Sequence[str]) -> DataFrame:
    return rows.filter(~reduce(or_, [is_missing(n) for n in needed]))


def any_set_aside() -> Column:
    return F.col(SET_ASIDE).isNotNull()


def delivered(rows: DataFrame, keep_set_aside: bool) -> DataFrame:
    """Cleaned rows with or without the numbers set aside."""
    return rows if keep_set_aside else rows.drop(SET_ASIDE)


def numbers_set_aside(raw: DataFrame, row_id: str, numbers: Sequence[str]) -> DataFrame:
    """One row for every number that is too large: id, column, text, reason.  One scan, no exchange."""
    rows = strip_all(raw.select(row_id, *[f"`{n}`" for n in numbers]))
    return rows.select(row_id, F.inline(set_aside(rows, numbers)))


@dataclass(frozen=True)
class Finding:
    """A business rule: when a row breaks it, what was found, and the value or limit expected."""

    broken: Column
    text: Column | None = None
    value: Column | None = None
    expected: Column | None = None


def finding_counts(rows: DataFrame, findings: Mapping[str, Finding]) -> DataFrame:
    """One row: how many rows break each rule."""
    return rows.agg(*[F.count_if(f.broken).alias(name) for name, f in findings.items()])


def finding_rows(rows: DataFrame, row_id: str, findings: Mapping[str, Finding]) -> DataFrame:
    """One row for every rule that a row breaks: id, rule, found_text, found_value, expected_value.

    Every rule is evaluated once per row into an array that is unfolded in place: one scan, no exchange.
    Values are shown as doubles.
    """

    def shown(col: Column | None, kind: str) -> Column:
        return (F.lit(None) if col is None else col).cast(kind)

    checked = [
        F.when(
            f.broken,
            F.struct(
                F.lit(name).alias("rule"),
                shown(f.text, "string").alias("found_text"),
                shown(f.value, "double").alias("found_value"),
                shown(f.expected, "double").alias("expected_value"),
            ),
        )
        for name, f in findings.items()
    ]
    broken = F.filter(F.array(*checked), lambda f: f.isNotNull())
    return rows.select(F.col(row_id), F.inline(broken))


def any_row(df: DataFrame, rules: Mapping[str, Column], scope: str) -> dict[str, Column]:
    """Whether a correction applies, per rule.

    ``scope='dataset'``: one offending row switches the correction on for every row;
    all rules are evaluated by a single one-row aggregate used as a scalar subquery.
    ``scope='row'``: only offending rows are corrected.
    """
    safe = {name: F.coalesce(cond, F.lit(False)) for name, cond in rules.items()}
    if scope == "row":
        return safe
    if scope != "dataset":
        raise ValueError("scope must be 'dataset' or 'row'")
    flags = df.agg(
        F.struct(
            *[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in safe.items()]
        ).alias("flags")
    ).scalar()
    return {name: flags.getField(name) for name in safe}
