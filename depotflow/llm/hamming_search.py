"""Exact top-k search in Hamming space by multi-index hashing.

A binary code is cut into segments.  Two codes at distance d agree up to d // m bits in at least one of m
segments, so after all segments were searched up to radius r, every code within m * (r + 1) - 1 has been
found.  Queries start at radius 0 and grow it by one each round; a query is done as soon as its k-th smallest
verified distance is no more than that bound.

Equal codes are one entry of the index, with their k smallest ids: others cannot be among the k nearest.
Queries with equal codes search once.  A round probes the segment values at exactly its radius; when those
values outnumber the values that exist, the existing values near the queries' are looked up instead.  For that a
segment is cut once more: values at distance r agree up to r // 2 bits in the lower half, or up to (r - 1) // 2
in the upper one, so they meet at a half's value, which at most 2 ** (``WIDEST`` / 2) values of a segment have.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.llm.tables import Scratch

#: Bits of a word of a code, most masks that a round enumerates, and most bits of a segment.
WORD, MASKS, WIDEST = 64, 100_000, 24


def sign_codes(vectors: DataFrame, vector: str, bits: int) -> DataFrame:
    """Append ``code``: words of 64 bits, each bit set where the vector's component is above zero.

    Missing components count as zero; a null vector has a null code.
    """

    @F.pandas_udf("array<long>")
    def code(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = -(-bits // WORD)
        for series in parts:
            out = []
            for v in series:
                if v is None:
                    out.append(None)
                    continue
                flags = np.zeros(words * WORD, dtype=np.uint8)
                given = np.asarray([x if x is not None else 0 for x in v[:bits]], dtype=np.float64)
                flags[: len(given)] = given > 0
                out.append(np.packbits(flags, bitorder="little").view(np.int64).tolist())
            yield pd.Series(out)

    return vectors.withColumn("code", code(F.col(vector)))


def segment_bits(codes: int, bits: int) -> int:
    """Bits of a segment: about as many as tell the codes apart."""
    return max(1, min(bits, WIDEST, round(log2(max(codes, 2)))))


def _segments(bits: int, width: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    m = -(-bits // width)
    edges = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(code: Column, first: int, width: int) -> Column:
    """Bits of a code as a number."""
    word, shift = divmod(first, WORD)
    value = F.shiftrightunsigned(F.get(code, F.lit(word)), shift)
    if shift + width > WORD:
        value = value.bitwiseOR(F.shiftleft(F.get(code, F.lit(word + 1)), WORD - shift))
    return value.bitwiseAND(F.lit((1 << width) - 1))


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _near_values(asked: DataFrame, existing: DataFrame, segments: list[tuple[int, int]], radius: int) -> DataFrame:
    """Existing values at exactly ``radius`` from those asked for: segment, value, present; each pair once.

    Both inputs have distinct rows (segment, value).
    """
    spark = asked.sparkSession
    limits = (radius // 2, (radius - 1) // 2)
    masks = None
    for width in sorted({w for _, w in segments}):
        for half, bits in enumerate((width // 2, width - width // 2)):
            # A half has WIDEST / 2 bits at most, so there are few masks whatever the data.
            some = spark.range(1 << bits).where(F.bit_count("id") <= limits[half])
            some = some.select(F.lit(width).alias("width"), F.lit(half).alias("half"), F.col("id").alias("mask"))
            masks = some if masks is None else masks.unionByName(some)
    width_of = F.element_at(F.array(*(F.lit(w) for _, w in segments)), F.col("segment") + 1)
    lower = "(shiftleft(1L, cast(width div 2 as int)) - 1)"
    halves = f"struct(0 as half, value & {lower} as part), struct(1 as half, shiftright(value, cast(width div 2 as int)) as part)"
    cut = lambda values: values.withColumn("width", width_of).selectExpr("segment", "value", "width", f"inline(array({halves}))")
    probes = cut(asked).join(F.broadcast(masks), ["width", "half"])
    probes = probes.select("segment", "value", "width", "half", F.col("part").bitwiseXOR(F.col("mask")).alias("part"))
    have = cut(existing).select("segment", "half", "part", F.col("value").alias("present"))
    met = probes.join(have.hint("merge"), ["segment", "half", "part"]).where(F.bit_count(F.expr("value ^ present")) == radius)
    # What meets in both halves counts in the lower one.
    once = (F.col("half") == 0) | (F.bit_count(F.expr(f"(value ^ present) & {lower}")) > limits[0])
    return met.where(once).select("segment", "value", "present")


def nearest(index: DataFrame, queries: DataFrame, bits: int, k: int) -> DataFrame:
    """Per query: query_id, rank (from 1), neighbour_id, distance.  Both inputs have id and code.

    Equal distances go by id.  A query may be its own neighbour.  Rows with a null code are neither indexed
    nor searched; repeated ids count as separate rows.  With fewer than k rows all are returned.
    """
    spark = index.sparkSession
    scratch = Scratch(spark)
    rows = index.where("code is not null and id is not null")
    # The k smallest ids of every code, in slices first so that no task sorts all copies of one code.
    slice_of = F.pmod(F.xxhash64("id"), F.lit(64))
    smallest = lambda c: F.slice(F.array_sort(c), 1, k)
    counted = rows.groupBy("code", "id").agg(F.count("*").alias("times"))
    listed = counted.select("code", F.explode(F.array_repeat("id", F.least("times", F.lit(k)).cast("int"))).alias("id"))
    ranked = listed.withColumn("at", F.expr("row_number() over (partition by code, pmod(xxhash64(id), 64) order by id)"))
    few = ranked.where(F.col("at") <= k).groupBy("code", slice_of.alias("slice")).agg(F.collect_list("id").alias("ids"))
    codes = few.groupBy("code").agg(smallest(F.flatten(F.collect_list("ids"))).alias("ids"))
    codes = scratch.put(codes.withColumn("entry", F.monotonically_increasing_id()), "codes")
    n = codes.count()
    asked = scratch.put(queries.where("code is not null and id is not null").select("id", "code"), "queries")
    open_queries = asked.select("code").distinct().withColumn("query", F.monotonically_increasing_id())
    searches = scratch.put(open_queries, "searches")
    if not n:
        return searches.select(F.lit(0).cast("long").alias("query_id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("neighbour_id"), F.lit(0).alias("distance")).limit(0)
    segments = _segments(bits, segment_bits(n, bits))
    parts = F.array(*(F.struct(F.lit(s).alias("segment"), _segment(F.col("code"), a, w).alias("value")) for s, (a, w) in enumerate(segments)))
    posted = scratch.put(codes.select("entry", F.explode(parts).alias("p")).select("entry", "p.segment", "p.value"), "postings")
    values = posted.select("segment", "value").distinct()
    widest = max(w for _, w in segments)
    found, left, done = None, searches, []
    for radius in range(widest + 1):
        probes = left.select("query", F.explode(parts).alias("p")).select("query", "p.segment", "p.value")
        if comb(widest, radius) <= min(n, MASKS):
            # All numbers of the segments' widths with as many bits; at most MASKS, so they are broadcast.
            masks = None
            for width in sorted({w for _, w in segments}):
                some = spark.range(1 << width).where(F.bit_count("id") == radius)
                some = some.select(F.lit(width).alias("width"), F.col("id").alias("mask"))
                masks = some if masks is None else masks.unionByName(some)
            width_of = F.element_at(F.array(*(F.lit(w) for _, w in segments)), F.col("segment") + 1)
            probes = probes.withColumn("width", width_of).join(F.broadcast(masks), "width")
            probes = probes.select("query", "segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
        else:
            near = _near_values(probes.select("segment", "value").distinct(), values, segments, radius)
            probes = probes.join(near, ["segment", "value"]).select("query", "segment", F.col("present").alias("value"))
        pairs = probes.join(posted.hint("merge"), ["segment", "value"]).select("query", "entry").distinct()
        # Pairs grow with the codes: sorted merges, since a size seen before they unfold tells too little.
        pairs = pairs.join(left.select("query", F.col("code").alias("asked")).hint("merge"), "query")
        pairs = pairs.join(codes.select("entry", "code", "ids").hint("merge"), "entry")
        hits = pairs.select("query", "entry", _distance(F.col("asked"), F.col("code")).alias("distance"), "ids")
        if found is not None:
            hits = hits.unionByName(found).dropDuplicates(["query", "entry"])
        # The nearest codes that together have k ids are enough.
        order = "partition by query order by distance, ids[0]"
        hits = hits.withColumn("before", F.expr(f"sum(size(ids)) over ({order} rows between unbounded preceding and 1 preceding)"))
        # Codes at the distance of the k-th id still count, for their ids may be smaller.
        kth = F.expr("min(case when coalesce(before, 0) + size(ids) >= %d then distance end) over (partition by query)" % k)
        hits = scratch.put(hits.withColumn("kth", kth).where("kth is null or distance <= kth").drop("before"), f"hits-{radius}")
        covered = len(segments) * (radius + 1) - 1
        if radius == widest:
            covered = bits
        finished = hits.where(F.col("kth") <= covered) if radius < widest else hits
        done.append(finished.select("query", "distance", "ids"))
        over = finished.select("query").distinct()
        left = scratch.put(left.join(over, "query", "left_anti"), f"left-{radius}")
        if left.isEmpty():
            break
        found = hits.join(over, "query", "left_anti").select("query", "entry", "distance", "ids")
    every = done[0]
    for some in done[1:]:
        every = every.unionByName(some)
    flat = every.select("query", "distance", F.explode("ids").alias("neighbour_id"))
    flat = flat.withColumn("rank", F.expr("row_number() over (partition by query order by distance, neighbour_id)")).where(F.col("rank") <= k)
    named = asked.join(searches, "code").select(F.col("id").alias("query_id"), "query")
    return named.join(flat, "query").select("query_id", "rank", "neighbour_id", "distance")
