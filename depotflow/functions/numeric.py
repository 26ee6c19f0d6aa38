"""Exact arithmetic helpers: decimals for amounts, guarded ratios, right-closed bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

NUMBER = "decimal(38,10)"  # measure parsed from text
MONEY = "decimal(18,2)"


def too_large(col: Column) -> Column:
    """A finite number that the decimal cannot hold (never null)."""
    wide = col.try_cast("double")
    finite = wide.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))
    return col.try_cast(NUMBER).isNull() & F.coalesce(finite, F.lit(False))


def to_number(col: Column) -> Column:
    """Coerce text to a decimal; text that is not a number (also NaN) becomes null.

    A number too large for the decimal is an error: it must not count as missing.  Jobs that go on
    instead cast with ``try_cast(NUMBER)`` and keep what is ``too_large`` aside.
    """
    message = F.concat(F.lit("number out of range: "), col.cast("string"))
    return F.when(too_large(col), F.raise_error(message).cast(NUMBER)).otherwise(col.try_cast(NUMBER))


def floor_at_zero(col: Column) -> Column:
    """Raise negatives to zero, keep nulls (``greatest`` would replace them)."""
    return F.when(col < 0, F.lit(0)).otherwise(col)


def cap_at(col: Column, limit: Column) -> Column:
    """Lower values above ``limit`` to it; keep nulls on either side."""
    return F.when(col > limit, limit).otherwise(col)


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def half_up(col: Column, scale: int) -> Column:
    """Round a number half away from zero on its decimal digits, not its binary ones.

    Spark rounds a double by its shortest decimal form, and once; the cast only fixes the scale.
    """
    return F.round(col, scale).cast(f"decimal(38,{scale})")


def ratio(num: Column, den: Column, scale: int | None = None) -> Column:
    """``num / den``; null when the denominator is zero."""
    value = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return value if scale is None else half_up(value, scale)


def percent(num: Column, den: Column, scale: int = 2) -> Column:
    """``100 * num / den`` rounded; null when the denominator is zero."""
    value = num.cast("double") * F.lit(100.0) / F.nullif(den.cast("double"), F.lit(0.0))
    return half_up(value, scale)


def right_closed_bin(col: Column, edges: Sequence[float | None], labels: Sequence[str]) -> Column:
    """Label ``(lo, hi]`` intervals; outside all of them the label is null.

    A final edge of ``None`` leaves the last interval open.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        inside = col > F.lit(lo) if hi is None else (col > F.lit(lo)) & (col <= F.lit(hi))
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def ladder(col: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Descending threshold ladder: first ``col >= threshold`` wins; null falls through."""
    out = None
    for threshold, label in steps:
        hit = col >= F.lit(threshold)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def ladder_up(col: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Ascending threshold ladder: first ``col <= threshold`` wins; null falls through."""
    out = None
    for threshold, label in steps:
        hit = col <= F.lit(threshold)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)
