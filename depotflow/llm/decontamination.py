"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest hashes of k-word sequences in every run of w neighbouring ones.  Two
texts that share k + w - 1 words in a row share a run, hence a fingerprint.  Fingerprints of documents and
benchmark items are joined; each hit is extended to both sides as far as the words agree, and counts if the
common span has a whole window.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window.  Lengths below
``WINDOW`` that occur in the benchmark get their own (k, w) with k + w - 1 equal to that length, so the
guarantee holds for every item.  Words are compared by 64-bit hashes; a wrong span needs as many collisions
in a row as it has words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.tables import row_key, stored
from depotflow.llm.wordhash import ALNUM, Words, grams, mix, signed, slices, words

WINDOW = 13


def gram_and_run(length: int) -> tuple[int, int]:
    """k and w with k + w - 1 = ``length``: about half of it each."""
    k = (length + 1) // 2
    return k, length - k + 1


def winnow(found: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of every row's words, the place of their first word in the row, and where rows begin.

    Rows with fewer words than ``length`` have none.  Among equal smallest hashes the last one counts;
    neighbouring runs that choose the same place give one fingerprint.
    """
    k, w = gram_and_run(length)
    hashes, starts = grams(found.hashes, found.bounds, k)
    counts = np.maximum(np.diff(starts) - w + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    if not len(rows):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, np.zeros(len(counts) + 1, dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    at = starts[:-1][rows] + np.arange(len(rows)) - first[rows]
    best, place = hashes[at], at
    for j in range(1, w):
        other = hashes[at + j]
        take = other <= best
        best, place = np.where(take, other, best), np.where(take, at + j, place)
    new = np.ones(len(rows), dtype=bool)
    new[1:] = place[1:] != place[:-1]
    rows = rows[new]
    bounds = np.searchsorted(rows, np.arange(len(counts) + 1))
    return mix(best[new] + np.uint64(length)), place[new] - starts[:-1][rows], bounds


def fingerprints(texts: DataFrame, lengths: list[int], text: str = "text") -> DataFrame:
    """Append ``n_words`` and ``prints``: the distinct fingerprints for each of the guaranteed lengths."""
    kept = [c for c in texts.columns if c != text]
    source = texts.select(*kept, text)
    schema = source.select(*kept, F.lit(0).cast("long").alias("n_words"), F.array(F.lit(0).cast("long")).alias("prints"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(len(kept))):
                found = words(part, ALNUM)
                levels = [winnow(found, n) for n in lengths]
                prints = [
                    np.unique(np.concatenate([h[b[i] : b[i + 1]] for h, _, b in levels])) for i in range(len(part))
                ]
                ends = np.cumsum([0, *map(len, prints)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(part.first, len(part)) for c in range(len(kept))),
                        pa.array(found.counts, pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(signed(np.concatenate(prints)), pa.int64())
                        ),
                    ],
                    [*kept, "n_words", "prints"],
                )

    return source.mapInArrow(run, schema.schema)


def spans(doc: list[int], prints: dict[int, list[int]], item: list[int], own: list[tuple[int, int]]) -> list:
    """Spans (start, end) of the document's words that extend hits to whole windows of the item."""
    least = min(len(item), WINDOW)
    done: dict[int, int] = {}  # end of the last span of a diagonal
    out = []
    for fingerprint, j in own:
        for i in prints.get(fingerprint, ()):
            if done.get(i - j, -1) > i:
                continue
            a, b = i, j
            while a and b and doc[a - 1] == item[b - 1]:
                a, b = a - 1, b - 1
            c, d = i, j
            while c < len(doc) and d < len(item) and doc[c] == item[d]:
                c, d = c + 1, d + 1
            done[i - j] = max(c, i + 1)
            if c - a >= least:
                out.append((a, c))
    return out


def _places(found: Words, length: int) -> list[list[tuple[int, int]]]:
    """Per row: fingerprints with their places, by place."""
    hashes, place, bounds = winnow(found, length)
    pairs = list(zip(hashes.tolist(), place.tolist()))
    return [pairs[i:j] for i, j in zip(bounds, bounds[1:])]


def extend(candidates: DataFrame) -> DataFrame:
    """Hit words and items of documents (key_a, key_b, text, items as array of item_id and text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {"key_a": [], "key_b": [], "n_hit": [], "item_ids": []}
            for i in range(batch.num_rows):
                part = next(slices(batch.column(2).slice(i, 1)))
                doc = words(part, ALNUM)
                doc_words, items = doc.hashes.tolist(), batch.column(3)[i].as_py()
                hit = np.zeros(len(doc.hashes) + 1, dtype=np.int64)
                prints: dict[int, dict[int, list[int]]] = {}
                ids = set()
                for item in items:
                    its = words(next(slices(pa.array([item["text"]]))), ALNUM)
                    length = min(len(its.hashes), WINDOW)
                    if length not in prints:
                        prints[length] = {}
                        for fingerprint, place in _places(doc, length)[0]:
                            prints[length].setdefault(fingerprint, []).append(place)
                    common = spans(doc_words, prints[length], its.hashes.tolist(), _places(its, length)[0])
                    for a, b in common:
                        hit[a] += 1
                        hit[b] -= 1
                    if common and item["item_id"] is not None:
                        ids.add(item["item_id"])
                found["key_a"].append(batch.column(0)[i].as_py())
                found["key_b"].append(batch.column(1)[i].as_py())
                found["n_hit"].append(int((np.cumsum(hit) > 0).sum()))
                found["item_ids"].append(sorted(ids, key=str))
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(found[c], pa.int64()) for c in ("key_a", "key_b", "n_hit")),
                    pa.array(found["item_ids"], pa.list_(pa.int64())),
                ],
                list(found),
            )

    rows = candidates.select("key_a", "key_b", "text", "items")
    return rows.mapInArrow(run, "key_a long, key_b long, n_hit long, item_ids array<long>")


def contamination(docs: DataFrame, benchmark: DataFrame, keyed: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, item_ids, contaminated.

    ``keyed`` appends the row's key_a and key_b (``row_key("doc_id", "text")``), for decisions on rows whose ids may
    be null or shared.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored.  A document is
    contaminated if it has hit words and they are a twentieth of its words or more.  Null and empty texts
    have no words; items without words have no windows.  Repeated documents give a row each.  Words that
    items with a null id share count as hit, but such items are not listed.  Empty tables are allowed.
    """
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull()).distinct()
    sized = fingerprints(items.select("item_id", F.col("text").alias("body"), "text"), [WINDOW]).select(
        "item_id", F.col("body").alias("text"), F.least("n_words", F.lit(WINDOW)).cast("int").alias("length")
    )
    lengths = sorted(r["length"] for r in sized.select("length").distinct().collect() if r["length"])
    texts = docs.select(*row_key("doc_id", "text"), "doc_id", "text")
    prints = stored(fingerprints(texts, lengths or [WINDOW]), "fingerprints")
    item_prints = None
    for n in lengths:  # at most WINDOW lengths
        some = sized.where(F.col("length") == n).select("item_id", F.col("text").alias("body"), "text")
        some = fingerprints(some, [n]).select("item_id", F.col("body").alias("text"), F.explode("prints").alias("print"))
        item_prints = some if item_prints is None else item_prints.unionByName(some)
    if item_prints is None:
        return prints.select(
            "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
            F.array().cast("array<long>").alias("item_ids"), F.lit(False).alias("contaminated"),
            *(["key_a", "key_b"] if keyed else []),
        )
    hits = (
        prints.select("key_a", "key_b", F.explode("prints").alias("print"))
        .join(item_prints, "print")
        .groupBy("key_a", "key_b")
        .agg(F.collect_set(F.struct("item_id", "text")).alias("items"))
    )
    rows = texts.select("key_a", "key_b", "text").join(hits, ["key_a", "key_b"])
    found = extend(rows).dropDuplicates(["key_a", "key_b"])
    none = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    return prints.join(found, ["key_a", "key_b"], "left").select(
        "doc_id",
        "n_words",
        none.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        ((none > 0) & (20 * none >= F.col("n_words"))).alias("contaminated"),
        *(["key_a", "key_b"] if keyed else []),
    )
