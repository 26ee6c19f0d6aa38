import numpy as np
import pytest

from depotflow.llm import hamming_search
from depotflow.llm.hamming_search import _near_values, nearest, sign_codes


def run(spark, vectors, ids, asked, bits, k):
    rows = [(i, None if v is None else [float(x) for x in v], "x") for i, v in zip(ids, vectors)]
    codes = sign_codes(spark.createDataFrame(rows, "id long, v array<double>, segment string"), "v", bits).select("id", "code")
    got = nearest(codes, codes.where(codes.id.isin(asked)), bits, k).collect()
    return sorted((r["query_id"], r["rank"], r["neighbour_id"], r["distance"]) for r in got)


def brute(vectors, ids, asked, k):
    rows = [(i, np.asarray(v) > 0) for i, v in zip(ids, vectors) if v is not None and i is not None]
    out = []
    for q, code in rows:
        if q in asked:
            best = sorted((int((c != code).sum()), i) for i, c in rows)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("bits, n, copies", [(16, 200, 0), (64, 300, 120), (70, 150, 10), (5, 60, 0)])
def test_exact_with_ties_and_copies(spark, bits, n, copies):
    rng = np.random.default_rng(bits)
    vectors = list(rng.normal(size=(n, bits)))
    vectors[10 : 10 + copies] = [vectors[10]] * copies
    ids = rng.permutation(n).tolist()
    asked = {i for i in ids if i % 20 == 0}
    assert run(spark, vectors, ids, asked, bits, 7) == brute(vectors, ids, asked, 7)


def test_nulls_few_rows_and_empty(spark):
    vectors, ids = [[1, -1, 1], None, [1, 1, 1], [1, 1, 1]], [1, 2, 3, None]
    assert run(spark, vectors, ids, [1, 2], 3, 5) == [(1, 1, 1, 0), (1, 2, 3, 1)]
    assert run(spark, [], [], [1], 3, 5) == []
    assert run(spark, vectors[:1], [1], [9], 3, 5) == []


@pytest.mark.parametrize("bits, n", [(16, 150), (5, 40), (70, 80)])
def test_values_that_exist_instead_of_masks(spark, monkeypatch, bits, n):
    monkeypatch.setattr(hamming_search, "MASKS", 1)
    rng = np.random.default_rng(n)
    vectors, ids = list(rng.normal(size=(n, bits))), list(range(n))
    asked = {i for i in ids if i % 10 == 0}
    assert run(spark, vectors, ids, asked, bits, 6) == brute(vectors, ids, asked, 6)


@pytest.mark.parametrize("radius", [1, 2, 3, 6])
def test_near_values_are_found_once(spark, radius):
    segments = [(0, 7), (7, 6)]
    rng = np.random.default_rng(radius)
    asked, existing = ({(s, int(v)) for s, w in enumerate((7, 6)) for v in rng.integers(0, 1 << w, 40)} for _ in range(2))
    frames = (spark.createDataFrame(sorted(x), "segment int, value long") for x in (asked, existing))
    got = sorted(tuple(r) for r in _near_values(*frames, segments, radius).collect())
    assert got == sorted((s, v, p) for s, v in asked for t, p in existing if s == t and (v ^ p).bit_count() == radius)
