"""Centroid clustering of whole-number vectors, exact, with a VA-file.

The VA-file holds, for every vector, a cell of a few bits for each dimension beside the full vector.  A cell is an
interval of values.  For given centroids a lookup table has, for every dimension, cell and centroid, the least and the
greatest square that the dimension can add to the distance; their sums over the dimensions are an interval that holds
the exact distance.  Centroids whose interval begins above the lowest end of another are out.  Where one is left,
the cells alone decide; full vectors are fetched, and exact distances computed, only where intervals overlap.

A scan delivers cells and vectors of a batch side by side, and a fetch decodes those rows of the batch that need
it.  A join of the needed rows would shuffle the whole vector column for a part of its rows instead.

The means are exact: sums are kept as whole numbers.  After the first round only the vectors that left their first
cluster, or whose intervals overlap, are fetched: the sums of the first round change by those that moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from depotflow.llm.tables import Scratch

#: Bits of a cell, and standard deviations from the mean as far as the cells of equal width reach (the outer ones
#: go on to the least and greatest value).
BITS, SPREAD = 6, 3.0

#: Vectors that are looked up at a time.
ROWS = 1 << 13


def largest_component(dims: int) -> int:
    """Magnitude of components up to which no squared distance exceeds a long."""
    return int(((1 << 62) // dims) ** 0.5) // 2


def whole_vectors(column: pa.Array, dims: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column have ``dims`` finite components and no null, and their floor(factor * x)."""
    long = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    values = column.filter(long).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    finite = np.isfinite(values).all(axis=1)
    kept = long.to_numpy(zero_copy_only=False).copy()
    kept[np.flatnonzero(kept)[~finite]] = False
    with np.errstate(over="ignore"):
        scaled = np.floor(factor * values[finite])
    if len(scaled) and not np.abs(scaled).max() <= largest_component(dims):
        raise ArithmeticError(f"a component is beyond {largest_component(dims)}: its squared distances are no longs")
    return kept, scaled.astype(np.int64)


def cell_edges(stats: list[tuple[int, int, float, float]], bits: int = BITS, spread: float = SPREAD) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each cell, (dims, cells), from (low, high, mean, deviation) of each dimension.

    A cell that no whole number falls into has its least value above its greatest.
    """
    low, high, mean, deviation = (np.array(x) for x in zip(*stats))
    steps = np.linspace(-spread, spread, (1 << bits) - 1)
    edges = np.ceil(mean[:, None] + steps[None, :] * deviation[:, None]).astype(np.int64)
    edges = np.clip(edges, low[:, None], high[:, None] + 1)
    return np.column_stack([low, edges]), np.column_stack([edges - 1, high])


def cells_of(vectors: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """Cell of every component, one byte each."""
    return np.column_stack([np.searchsorted(lows[d, 1:], vectors[:, d], "right") for d in range(vectors.shape[1])]).astype(np.uint8)


def lookup(lows: np.ndarray, highs: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squares, (dims, cells, centroids), between the values of a cell and a centroid."""
    below = lows[:, :, None] - centroids.T[:, None, :]
    above = highs[:, :, None] - centroids.T[:, None, :]
    ends = below * below, above * above
    return np.where((below <= 0) & (above >= 0), 0, np.minimum(*ends)), np.maximum(*ends)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, (vectors, centroids)."""
    out = np.empty((len(vectors), len(centroids)), dtype=np.int64)
    for c, centroid in enumerate(centroids):
        apart = vectors - centroid
        out[:, c] = np.einsum("ij,ij->i", apart, apart)
    return out


def nearest(cells: np.ndarray, fetch, tables: tuple[np.ndarray, np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of each vector's nearest centroid (the smaller one of equals), and how many vectors were fetched.

    ``fetch`` takes row numbers and returns those full vectors.
    """
    out, fetched = np.empty(len(cells), dtype=np.int64), 0
    least, most = tables
    for at in range(0, len(cells), ROWS):
        part = cells[at : at + ROWS]
        low = np.zeros((len(part), len(centroids)), dtype=np.int64)
        high = np.zeros_like(low)
        for d in range(part.shape[1]):
            low += least[d][part[:, d]]
            high += most[d][part[:, d]]
        left = low <= high.min(axis=1, keepdims=True)
        own = left.argmax(axis=1)
        several = np.flatnonzero(left.sum(axis=1) > 1)
        if len(several):
            exact = distances(fetch(at + several), centroids)
            exact[~left[several]] = np.iinfo(np.int64).max
            own[several] = exact.argmin(axis=1)
            fetched += len(several)
        out[at : at + ROWS] = own
    return out, fetched


def _packed(rows: np.ndarray) -> pa.Array:
    """The bytes of each row of a matrix as a binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _bytes(column: pa.Array, dtype: type, dims: int) -> np.ndarray:
    """The matrix behind a column of binary values of equal length, without a copy."""
    column = column.cast(pa.large_binary())
    _, where, data = column.buffers()
    if not len(column):
        return np.zeros((0, dims), dtype=dtype)
    first = np.frombuffer(where, dtype=np.int64)[column.offset]
    return np.frombuffer(data, dtype=dtype, count=len(column) * dims, offset=int(first)).reshape(-1, dims)


class _Vectors:
    """Full vectors of a batch as stored; those that are asked for are decoded to 64 bits."""

    def __init__(self, column: pa.Array, dtype: type, dims: int) -> None:
        self.packed = _bytes(column, dtype, dims)

    def fetch(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        return self.packed[rows].astype(np.int64)


def _component_sums(clusters: np.ndarray, vectors: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and component sums of the vectors of each cluster, each vector counted ``weights`` times."""
    order = np.argsort(clusters, kind="stable")
    clusters, vectors, weights = clusters[order], vectors[order] * weights[order, None], weights[order]
    first = np.flatnonzero(np.diff(clusters, prepend=-1))
    n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, vectors.shape[1]), dtype=np.int64)
    if len(clusters):
        n[clusters[first]] = np.add.reduceat(weights, first)
        sums[clusters[first]] = np.add.reduceat(vectors, first)
    return n, sums


_SUMS = "cluster int, dim int, n long, total long"


def _sums_batch(n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """One row for each cluster and dimension: what a task adds to the means."""
    k, dims = sums.shape
    columns = [np.repeat(np.arange(k), dims), np.tile(np.arange(dims), k), np.repeat(n, dims), sums.ravel()]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["cluster", "dim", "n", "total"])


def _summed(parts: DataFrame, k: int, dims: int) -> tuple[list[int], list[list[int]]]:
    """Add up the rows of all tasks: k times dims numbers, whatever the input."""
    n, sums = [0] * k, [[0] * dims for _ in range(k)]
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    for r in parts.groupBy("cluster", "dim").agg(total("n"), total("total")).collect():
        n[r["cluster"]], sums[r["cluster"]][r["dim"]] = int(r["n"]), int(r["total"])
    return n, sums


def centroid_digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(df: DataFrame, vector: str, row_id: str, k: int, rounds: int, dims: int, factor: float = 64.0) -> DataFrame:
    """Per kept vector: the id column, cluster, distance, cluster_inertia, inertia, centroid (array of long).

    Kept are vectors of exactly ``dims`` components, none null or non-finite; each component x becomes
    floor(factor * x).  Centroids start as the k kept vectors with the smallest lowercase-hex sha256 of
    ``1:<id>``, in that order (equal hashes: smaller vector first; null ids last).  A round assigns every vector to
    its nearest centroid (equal distances: smaller number) and replaces every non-empty centroid by the floor of the
    mean of its vectors.  After ``rounds`` of them the vectors are assigned once more; ``distance`` is squared, and
    the inertias sum it over the cluster and over all.

    Fewer kept vectors than k give as many centroids; none give an empty table, as an empty table does.  Repeated
    rows count each, also as centroids (then the second one stays empty); a null id is kept.  Other columns are
    ignored.  A component beyond ``largest_component(dims)`` ends the run with an error, for its distances would not
    fit a long.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    source = df.select(F.col(row_id).alias("id"), F.col(vector).alias("vector"))
    id_field = source.schema["id"]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, whole = whole_vectors(batch.column(1), dims, factor)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1) * dims, pa.int32()), pa.array(whole.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept)), vectors], ["id", "vector"])

    def spreads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(dims), np.zeros(dims)
        low, high = np.full(dims, np.iinfo(np.int64).max), np.full(dims, np.iinfo(np.int64).min)
        for batch in batches:
            _, whole = whole_vectors(batch.column(0), dims, factor)
            if len(whole):
                n, sums, squares = n + len(whole), sums + whole.sum(axis=0), squares + (whole.astype(float) ** 2).sum(axis=0)
                low, high = np.minimum(low, whole.min(axis=0)), np.maximum(high, whole.max(axis=0))
        if n:
            columns = [pa.array(np.arange(dims), pa.int32()), pa.array(np.full(dims, n), pa.int64()), *map(pa.array, (sums, squares, low, high))]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "n", "sums", "squares", "low", "high"])

    columns = StructType([id_field]).add("vector", ArrayType(LongType()))
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256)
    starts = source.mapInArrow(decoded, columns).withColumn("hash", hashed)
    starts = starts.orderBy(F.col("hash").asc_nulls_last(), "vector").limit(k).select("vector").collect()
    parts = source.select("vector").mapInArrow(spreads, "dim int, n long, sums double, squares double, low long, high long")
    spread = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("sums").alias("sums"), F.sum("squares").alias("squares"), F.min("low").alias("low"), F.max("high").alias("high"))
    stats = []
    for r in sorted(spread.collect(), key=lambda r: r["dim"]):
        mean = r["sums"] / r["n"]
        stats.append((r["low"], r["high"], mean, max(r["squares"] / r["n"] - mean * mean, 0.0) ** 0.5))
    result = StructType([id_field]).add("cluster", "integer").add("distance", "long")
    if not starts:
        empty = spark.createDataFrame([], result.add("cluster_inertia", "long").add("inertia", "long").add("centroid", ArrayType(LongType())))
        return empty.withColumnRenamed("id", row_id)
    centroids = np.array([r["vector"] for r in starts], dtype=np.int64)
    lows, highs = cell_edges(stats)
    k = len(centroids)
    least, most = min(s[0] for s in stats), max(s[1] for s in stats)
    narrow = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)

    def encode(now: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = lookup(lows, highs, now)
            for batch in batches:
                kept, whole = whole_vectors(batch.column(1), dims, factor)
                cells = cells_of(whole, lows)
                own, _ = nearest(cells, whole.__getitem__, tables, now)
                ids = batch.column(0).filter(pa.array(kept))
                yield pa.RecordBatch.from_arrays([ids, _packed(cells), _packed(whole.astype(narrow)), pa.array(own, pa.int32())], ["id", "cells", "vector", "first"])

        return run

    def first_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            vectors = _Vectors(batch.column(0), narrow, dims).fetch()
            more = _component_sums(batch.column(1).to_numpy(), vectors, np.ones(len(vectors), dtype=np.int64), k)
            n, sums = n + more[0], sums + more[1]
        if n.any():
            yield _sums_batch(n, sums)

    def moved_sums(now: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = lookup(lows, highs, now)
            n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
            for batch in batches:
                vectors = _Vectors(batch.column(1), narrow, dims)
                own, _ = nearest(_bytes(batch.column(0), np.uint8, dims), vectors.fetch, tables, now)
                before = batch.column(2).to_numpy()
                moved = np.flatnonzero(own != before)
                if len(moved):
                    fetched = vectors.fetch(moved)
                    weights = np.ones(len(moved), dtype=np.int64)
                    for clusters, sign in ((own[moved], weights), (before[moved], -weights)):
                        more = _component_sums(clusters, fetched, sign, k)
                        n, sums = n + more[0], sums + more[1]
            if n.any() or sums.any():
                yield _sums_batch(n, sums)

        return run

    def assign(now: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = lookup(lows, highs, now)
            for batch in batches:
                vectors = _Vectors(batch.column(2), narrow, dims)
                own, _ = nearest(_bytes(batch.column(1), np.uint8, dims), vectors.fetch, tables, now)
                apart = vectors.fetch() - now[own]  # the result states every distance
                squares = np.einsum("ij,ij->i", apart, apart)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), pa.array(squares, pa.int64())], ["id", "cluster", "distance"])

        return run

    def means(n: list[int], sums: list[list[int]], now: np.ndarray) -> np.ndarray:
        return np.array([[s // n[c] for s in sums[c]] if n[c] else now[c] for c in range(k)], dtype=np.int64)

    stored = StructType([id_field]).add("cells", "binary").add("vector", "binary").add("first", "integer")
    # Without rounds the first assignment is the last one too.
    file = scratch.put(source.mapInArrow(encode(centroids), stored), "va-file")
    if rounds:
        n, sums = _summed(file.select("vector", "first").mapInArrow(first_sums, _SUMS), k, dims)
        centroids = means(n, sums, centroids)
    for _ in range(rounds - 1):
        dn, dsums = _summed(file.select("cells", "vector", "first").mapInArrow(moved_sums(centroids), _SUMS), k, dims)
        now = [n[c] + dn[c] for c in range(k)]
        total = [[s + d for s, d in zip(sums[c], dsums[c])] for c in range(k)]
        centroids = means(now, total, centroids)
    assigned = scratch.put(file.select("id", "cells", "vector").mapInArrow(assign(centroids), result), "assigned")
    scratch.drop("va-file")
    # k rows at most, so they go to every task.
    totals = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = totals.agg(F.sum("cluster_inertia").alias("inertia"))
    final = spark.createDataFrame([(c, [int(x) for x in v]) for c, v in enumerate(centroids)], "cluster int, centroid array<long>")
    known = F.broadcast(totals.join(final, "cluster").crossJoin(F.broadcast(whole)))
    return assigned.join(known, "cluster").select(F.col("id").alias(row_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
