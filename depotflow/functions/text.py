"""Text standardisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Every character that counts as white space when stripping text
# (Spark's one-argument trim() only removes the plain blank).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(col, F.lit(WHITESPACE))


def strip_all(df: DataFrame) -> DataFrame:
    """Strip every string column; other columns pass through untouched."""
    return df.select(
        *[
            strip(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def title_case(col: Column) -> Column:
    """Capitalise the first letter after *any* non-letter ('a/b' -> 'A/B').

    ``initcap`` alone only starts a new word at a blank.  That is enough for text made
    of letters and blanks; other text is cut into runs of letters and non-letters.
    """
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    by_runs = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(col.rlike(r"[^\p{L} ]"), by_runs).otherwise(F.initcap(col))


def is_member(col: Column, allowed: Iterable[str]) -> Column:
    """Null-safe membership: null is never a member."""
    return F.coalesce(col.isin(*sorted(allowed)), F.lit(False))


def with_percent_sign(col: Column) -> Column:
    """Display text with two decimals, e.g. 93.60%.  For labels only: never sort on it."""
    return F.concat(col.cast("decimal(18,2)").cast("string"), F.lit("%"))
