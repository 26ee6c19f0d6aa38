"""Group-by with several exact distinct counts, pre-aggregated before it shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.operators.bitmaps import bitmap_counts
from depotflow.operators.joins import with_dimension

Measure = tuple  # (kind, column name) with kind in sum / rows / min / max / avg / distinct


def rollup(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    dimension: tuple[DataFrame, str] | None = None,
    bitmaps: DataFrame | None = None,
    apart: bool = False,
) -> DataFrame:
    """Aggregate ``df`` by ``keys``.

    Without distinct counts this is one plain group-by.  With them, the rows are
    first folded to the grain (keys + counted columns) with partial sums, so that the
    multi-distinct expansion that follows copies folded rows instead of fact rows.  On
    a fact that was just joined on one of the counted columns the fold costs no extra
    exchange.  A hot value is combined on the map side in both steps.

    ``dimension`` (table, key) supplies keys that the fact does not carry.  They are
    joined after folding, never to the fact rows: to the finished result when the
    dimension's key is itself among ``keys``, otherwise to the folded rows.

    ``bitmaps`` is a stored mart (``operators.bitmaps``) of the same rows over ``keys`` or more: distinct
    counts come from it and ``df`` is folded for the other measures alone.

    ``apart`` is for a stored ``df`` and few groups: each counted column is folded with the keys alone and
    joined by group, and the sums, which map tasks fold to a row per group, do not travel with the ids.  ``df``
    is read once more for each counted column.
    """
    if apart and keys and bitmaps is None and dimension is None:
        return _apart(df, keys, measures)
    if bitmaps is not None:
        names = {name: spec[1] for name, spec in measures.items() if spec[0] == "distinct"}
        others = {name: spec for name, spec in measures.items() if name not in names}
        counts = bitmap_counts(bitmaps, keys, names)
        counts = counts.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        return rollup(df, keys, others, dimension).join(counts, same).select(*keys, *measures)
    counted = [spec[1] for spec in measures.values() if spec[0] == "distinct"]
    if dimension is not None:
        table, key = dimension
        own = [k for k in keys if k in df.columns]
        borrowed = [k for k in keys if k not in own]
        if key in own:
            done = with_dimension(rollup(df, own, measures), table, key, borrowed)
            return done.select(*keys, *measures)
        folded = with_dimension(_fold(df, [*own, key, *counted], measures), table, key, borrowed)
    elif counted:
        folded = _fold(df, [*keys, *counted], measures)
    else:
        return df.groupBy(*keys).agg(
            *[_direct(spec).alias(name) for name, spec in measures.items()]
        )
    return folded.groupBy(*keys).agg(
        *[_merged(name, spec).alias(name) for name, spec in measures.items()]
    )


def _apart(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    others = {name: spec for name, spec in measures.items() if spec[0] != "distinct"}
    out = rollup(df, keys, others) if others else df.select(*keys).distinct()
    for name, spec in measures.items():
        if spec[0] != "distinct":
            continue
        ids = df.select(*dict.fromkeys([*keys, spec[1]])).distinct()
        counts = ids.groupBy(*keys).agg(F.count(spec[1]).alias(name))
        counts = counts.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        out = out.join(counts, same).drop(*[f"_k_{k}" for k in keys])
    return out.select(*keys, *measures)


def _fold(df: DataFrame, grain: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    return df.groupBy(*dict.fromkeys(grain)).agg(
        *[part for name, spec in measures.items() for part in _partials(name, spec)],
        F.count(F.lit(1)).alias("_rows"),
    )


def _direct(spec: Measure) -> Column:
    kind = spec[0]
    if kind == "rows":
        return F.count(F.lit(1))
    if kind == "avg":
        total = F.sum(spec[1]).cast("double")
        return total / F.nullif(F.count(spec[1]).cast("double"), F.lit(0.0))
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](spec[1])


def _partials(name: str, spec: Measure) -> list[Column]:
    kind = spec[0]
    if kind in ("rows", "distinct"):
        return []
    if kind == "avg":
        return [F.sum(spec[1]).alias(f"_s_{name}"), F.count(spec[1]).alias(f"_n_{name}")]
    return [{"sum": F.sum, "min": F.min, "max": F.max}[kind](spec[1]).alias(f"_p_{name}")]


def _merged(name: str, spec: Measure) -> Column:
    kind = spec[0]
    if kind == "distinct":
        return F.count_distinct(spec[1])
    if kind == "rows":
        return F.sum("_rows")
    if kind == "avg":
        total = F.sum(f"_s_{name}").cast("double")
        return total / F.nullif(F.sum(f"_n_{name}").cast("double"), F.lit(0.0))
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](f"_p_{name}")


def average_of_totals(
    df: DataFrame, keys: Sequence[str], per: str, total: Column, name: str
) -> DataFrame:
    """Average over ``per`` (e.g. dates) of a total taken within each of its values."""
    totals = df.groupBy(*dict.fromkeys([*keys, per])).agg(total.alias("_total"))
    mean = F.sum("_total").cast("double") / F.count("_total").cast("double")
    return totals.groupBy(*keys).agg(mean.alias(name))


def row_counts(named: Mapping[str, DataFrame], label: str) -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias(label), "rows")
        for name, df in named.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy(label)
