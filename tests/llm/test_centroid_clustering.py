import hashlib
import math
import random

import numpy as np
import pytest

from depotflow.llm import centroid_clustering
from depotflow.llm.centroid_clustering import cell_edges, cells_of, cluster, lookup, nearest
from depotflow.llm.queries import QUERIES


def brute(rows, k, rounds, dims, factor=64.0):
    """All distances of all rounds, in Python's numbers."""
    kept = [(i, [math.floor(factor * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    starts = [v for _, v in sorted(named)] + sorted(v for i, v in kept if i is None)
    centroids = starts[:k]

    def own(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        found = [own(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), f in zip(kept, found) if f == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *own(v)[::-1]) for i, v in kept]
    by = {n: sum(d for _, m, d in last if m == n) for n in range(len(centroids))}
    return [(i, n, d, by[n], sum(by.values()), centroids[n]) for i, n, d in last]


def rows_of(seed, n, dims, spread):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, spread) for _ in range(dims)] for _ in range(5)]
    return [(i, [rnd.gauss(m, 0.2) for m in rnd.choice(middles)]) for i in range(n)]


def same(spark, rows, k=4, rounds=3, dims=3, kind="double"):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster string")
    got = [tuple(r) for r in cluster(df, "embedding", "vec_id", k, rounds, dims).collect()]
    order = lambda r: (r[0] is None, r[0], r[1:])
    assert sorted(got, key=order) == sorted(brute(rows, k, rounds, dims), key=order)
    return got


@pytest.mark.parametrize("spread", [0.0, 0.3, 4.0])
def test_equals_brute_force(spark, spread):
    same(spark, rows_of(int(10 * spread), 300, 3, spread))


def test_awkward_rows(spark):
    rows = rows_of(1, 60, 3, 1.0)
    rows += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [1.0, math.nan, 2.0]), (105, [math.inf, 0.0, 0.0])]
    rows += [(None, [0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5]), (7, [9.0, -9.0, 1e4]), (7, [9.0, -9.0, 1e4]), (8, [0.0, 0.0, 0.0])]
    assert len(same(spark, rows)) == 65
    same(spark, [(i % 3, [0.25, -0.25, 0.0]) for i in range(20)])  # ties everywhere, empty clusters
    assert len(same(spark, rows[:2] + rows[60:66], k=5)) == 2
    same(spark, rows[:40], rounds=0)
    same(spark, rows[:40], rounds=1)
    assert same(spark, rows[60:66]) == [] and same(spark, []) == []
    with pytest.raises(Exception, match="beyond"):
        same(spark, [(1, [1e300, 0.0, 0.0])])


def test_intervals_hold_the_distance_and_spare_fetches():
    rnd = np.random.default_rng(3)
    vectors = rnd.normal(rnd.normal(0, 30, (8, 16))[rnd.integers(0, 8, 3000)], 3).round().astype(np.int64)
    stats = list(zip(vectors.min(0), vectors.max(0), vectors.mean(0), vectors.std(0)))
    lows, highs = cell_edges(stats)
    cells = cells_of(vectors, lows)
    for d in range(16):
        assert (lows[d][cells[:, d]] <= vectors[:, d]).all() and (vectors[:, d] <= highs[d][cells[:, d]]).all()
    centroids = vectors[:8]
    exact = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    least, most = lookup(lows, highs, centroids)
    low = sum(least[d][cells[:, d]] for d in range(16))
    high = sum(most[d][cells[:, d]] for d in range(16))
    assert (low <= exact).all() and (exact <= high).all()
    asked = []
    own, fetched = nearest(cells, lambda rows: asked.append(rows) or vectors[rows], (least, most), centroids)
    assert (own == exact.argmin(1)).all()
    assert sum(map(len, asked)) == fetched < 1000


def test_coarse_cells_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(centroid_clustering, "cell_edges", lambda stats: cell_edges(stats, bits=2))
    same(spark, rows_of(9, 200, 3, 1.0))


def test_query_on_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    vectors = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    want = sorted((*r[:5], digest(r[5])) for r in brute(vectors, 16, 3, 64))
    assert sorted(tuple(r) for r in QUERIES["op11_va_centroids"](spark, sf).collect()) == want
