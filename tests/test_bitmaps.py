"""Distinct counts from bitmaps equal counting anew, at every grain, and merge without the facts."""

from __future__ import annotations

import pytest

from depotflow.operators.bitmaps import bitmap_counts, bitmap_mart, merged_bitmaps
from depotflow.operators.rollup import rollup
from depotflow.registry import queries

ROWS = [
    ("a", 1, 5, 1), ("a", 1, 5, 2), ("a", 1, 32768, 2), ("a", 1, 32769, 3), ("a", 2, 5, 4), ("a", 2, -7, 4),
    ("b", 1, None, 5), ("b", 1, None, 5), (None, 1, 0, 6), (None, 2, 1 << 40, 6), (None, 2, 7, 7),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "k string, m int, id bigint, invoice int")


@pytest.mark.parametrize("keys", [["k", "m"], ["k"], ["m"], []])
def test_equal_to_counting_anew(rows, keys):
    mart = bitmap_mart(rows, ["k", "m"], ["id", "invoice"])
    got = bitmap_counts(mart, keys, {"ids": "id", "invoices": "invoice"})
    want = {}
    for k, m, id_, invoice in ROWS:
        ids, invoices = want.setdefault(tuple({"k": k, "m": m}[c] for c in keys), (set(), set()))
        ids.update([id_] if id_ is not None else [])
        invoices.add(invoice)
    assert {tuple(r)[: len(keys)]: (r["ids"], r["invoices"]) for r in got.collect()} == {
        key: (len(a), len(b)) for key, (a, b) in want.items()
    }


def test_marts_of_parts_merge(rows):
    old, new = (bitmap_mart(rows.where(cond), ["k", "m"], ["id"]) for cond in ("m = 1", "m = 2"))
    both = merged_bitmaps(old.unionByName(new), ["k"])
    got = {r["k"]: r["n"] for r in bitmap_counts(both, ["k"], {"n": "id"}).collect()}
    assert got == {"a": 4, "b": 0, None: 3}


def test_empty_and_other_types(spark, rows):
    empty = bitmap_mart(rows.limit(0), ["k"], ["id"])
    assert bitmap_counts(empty, ["k"], {"n": "id"}).count() == 0
    assert bitmap_counts(empty, [], {"n": "id"}).first()["n"] == 0
    with pytest.raises(ValueError, match="whole number"):
        bitmap_mart(rows, ["m"], ["k"])


def test_rollup_takes_counts_from_the_mart(rows):
    measures = {"ids": ("distinct", "id"), "rows": ("rows",), "last": ("max", "invoice")}
    mart = bitmap_mart(rows, ["k", "m"], ["id"])
    one, two = (rollup(rows, ["k"], measures, bitmaps=b) for b in (None, mart))
    assert one.columns == two.columns and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


@pytest.mark.parametrize("name", ["sales_monthly_from_bitmaps", "sales_routes_from_bitmaps", "accounts_billing_from_bitmaps"])
def test_no_expand(spark, name):
    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_or_agg" in plan
