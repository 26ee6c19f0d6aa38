"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

``fit_words`` takes every word of the examples.  A word weighs its inverse document frequency, counted over all
documents, and more where its presence raises the toxic rate for certain (a confidence bound decides how much;
no word weighs less than its frequency gives).  Examples are labelled documents as unit vectors, in blocks of
similar ones.  The index is inverted: a term has its postings by block, and for each of these blocks the largest
weight.  A query bounds every block's cosine by these maxima, scores the blocks with the largest bounds, and
then those whose bound reaches the k-th best cosine found, so the neighbours are exact, ties included.

Neighbours vote with weights that fall with distance; a prior of the examples' rate keeps few or distant
votes moderate.  A text without any word of the examples has no cosine with anything; the rate of the examples
without words is its score.

``fit`` is the narrow form: its terms are only words that surely mark toxic documents, in dense vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from depotflow.llm.wordhash import ALNUM, Slice, signed, slices, words

#: Most terms, most examples, examples of a block, neighbours that vote.
TERMS, EXAMPLES, BLOCK, NEIGHBOURS = 512, 4096, 64, 15

#: A term's toxic rate must surely (so many standard errors) exceed the general rate so many times.
SURE, LIFT = 3.0, 2.0

#: Weight of a word for each time its toxic rate surely exceeds the general one, beside 1 for every word.
STRESS = 4.0

#: Blocks that a query scores before it compares bounds with what it has found.
FIRST_BLOCKS = 4

#: Weight of the general rate among the votes, and distance at which a vote's weight is halved.
PRIOR, HALF = 0.5, 0.1


@dataclass(frozen=True)
class Index:
    """Terms with their weights, and the examples' vectors in blocks with the blocks' maxima."""

    terms: np.ndarray  # sorted hashes
    idf: np.ndarray
    vectors: np.ndarray  # examples x terms, unit length
    ids: np.ndarray
    labels: np.ndarray
    maxima: np.ndarray  # blocks x terms
    rate: float
    bare_rate: float

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples; equal cosines go by example id."""
        bounds = self.maxima[:, at] @ weights
        places, cosines = np.zeros(0, dtype=np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or (len(places) == k and cosines[-1] > bounds[b] + 1e-9):
                break
            block = np.arange(b * BLOCK, min((b + 1) * BLOCK, len(self.ids)))
            found = np.round(self.vectors[block][:, at] @ weights, 9)
            block, found = block[found > 0], found[found > 0]
            places, cosines = np.concatenate([places, block]), np.concatenate([cosines, found])
            best = np.lexsort((self.ids[places], -cosines))[:k]
            places, cosines = places[best], cosines[best]
        return places, cosines

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        weights = HALF / (HALF + 1 - np.minimum(cosines, 1))
        return float((weights @ self.labels[places] + PRIOR * self.rate) / (weights.sum() + PRIOR))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the given ranges, one range after the other."""
    n = ends - starts
    return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())


@dataclass(frozen=True)
class WordIndex:
    """Inverted lists of all words.  Term t has the entries ``first[t]`` to ``first[t + 1]``, one for each block
    that holds it; an entry has its block, its largest weight and the postings from ``edges`` on."""

    terms: np.ndarray  # sorted hashes
    idf: np.ndarray
    first: np.ndarray
    blocks: np.ndarray
    maxima: np.ndarray
    edges: np.ndarray
    places: np.ndarray  # postings: example and weight
    weights: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    rate: float
    bare_rate: float

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples; equal cosines go by example id."""
        begin, end = self.first[at], self.first[at + 1]
        entries = _ranges(begin, end)
        weight = np.repeat(weights, end - begin)
        of = self.blocks[entries]
        bounds = np.bincount(of, weights=weight * self.maxima[entries], minlength=-(-len(self.ids) // BLOCK))
        order = np.argsort(-bounds, kind="stable")
        now = np.zeros(len(bounds), dtype=bool)
        now[order[:FIRST_BLOCKS]] = True
        now &= bounds > 0
        left = (bounds > 0) & ~now
        places, cosines = np.zeros(0, dtype=np.int64), np.zeros(0)
        while now.any():
            if 2 * now.sum() > len(now):  # most blocks: whole lists, which stand together, are faster
                one, two = self.edges[begin], self.edges[end]
                own, lists = weights, [slice(i, j) for i, j in zip(one.tolist(), two.tolist())]
                where, by = (np.concatenate([x[i] for i in lists]) for x in (self.places, self.weights))
            else:
                some = entries[now[of]]
                own, one, two = weight[now[of]], self.edges[some], self.edges[some + 1]
                postings = _ranges(one, two)
                where, by = self.places[postings], self.weights[postings]
            every = np.bincount(where, weights=np.repeat(own, two - one) * by, minlength=len(self.ids))
            found = np.flatnonzero(every > 0)
            found = found[now[found // BLOCK]]
            every = np.round(every[found], 9)
            found, every = found[every > 0], every[every > 0]
            if len(found) > k:
                near = every >= np.partition(every, -k)[-k]
                found, every = found[near], every[near]
            places, cosines = np.concatenate([places, found]), np.concatenate([cosines, every])
            best = np.lexsort((self.ids[places], -cosines))[:k]
            places, cosines = places[best], cosines[best]
            now = left & (bounds + 1e-9 >= cosines[-1]) if len(places) == k else left
            left = np.zeros_like(left)
        return places, cosines

    vote = Index.vote


def word_index(terms, idf, found: list[tuple[np.ndarray, np.ndarray]], ids, labels, rate: float) -> WordIndex:
    """Index of examples; ``found`` has the places among the terms, and the counts, of the words of each."""
    vectors = [weigh(at, counts, idf) if len(at) else np.zeros(0) for at, counts in found]
    # Similar examples side by side: by heaviest term, then by its weight; those without words come last.
    heaviest = np.array([at[v.argmax()] if len(v) else len(terms) for (at, _), v in zip(found, vectors)], dtype=np.int64)
    most = np.array([v.max() if len(v) else 0.0 for v in vectors])
    order = np.lexsort((ids, -most, heaviest))
    sizes = np.array([len(found[i][0]) for i in order], dtype=np.int64)
    term = np.concatenate([np.zeros(0, dtype=np.int64), *(found[i][0] for i in order)])
    weights = np.concatenate([np.zeros(0), *(vectors[i] for i in order)])
    places = np.repeat(np.arange(len(order)), sizes)
    by_term = np.argsort(term, kind="stable")  # places rise within a term
    term, weights, places = term[by_term], weights[by_term], places[by_term]
    blocks = places // BLOCK
    new = np.ones(len(term), dtype=bool)
    new[1:] = (term[1:] != term[:-1]) | (blocks[1:] != blocks[:-1])
    edges = np.flatnonzero(new)
    maxima = np.maximum.reduceat(weights, edges) if len(edges) else np.zeros(0)
    first = np.searchsorted(term[edges], np.arange(len(terms) + 1))
    bare = sizes == 0
    bare_rate = (labels[order][bare].sum() + 2 * PRIOR * rate) / (bare.sum() + 2 * PRIOR)
    return WordIndex(
        terms, idf, first, blocks[edges], maxima, np.append(edges, len(term)),
        places, weights, ids[order], labels[order], rate, float(bare_rate),
    )


def matches(part: Slice, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every term that a row of the slice contains, by row and term."""
    found = words(part, ALNUM)
    if not len(terms) or not len(found.hashes):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(terms, found.hashes), len(terms) - 1)
    hit = terms[at] == found.hashes
    keys, counts = np.unique(found.rows[hit] * len(terms) + at[hit], return_counts=True)
    return keys // len(terms), keys % len(terms), counts


def weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * idf[at]
    return weights / np.sqrt((weights**2).sum())


def term_rates(labelled: DataFrame, label: str) -> DataFrame:
    """Per word hash: documents and toxic documents that contain it; hash null counts all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(0)):
                found = words(part, ALNUM)
                toxic = y[part.first : part.first + len(part)] == 1
                order = np.lexsort((found.hashes, found.rows))
                h, rows = found.hashes[order], found.rows[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
                h, at = np.unique(h[new], return_inverse=True)
                n = np.bincount(at, minlength=len(h))
                bad = np.bincount(at, weights=toxic[rows[new]], minlength=len(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None, *signed(h).tolist()], pa.int64()),
                        pa.array([len(part), *n.tolist()], pa.int64()),
                        pa.array([int(toxic.sum()), *bad.tolist()], pa.int64()),
                    ],
                    ["term", "n", "toxic"],
                )

    pairs = labelled.select("text", F.col(label).cast("int"))
    counted = pairs.mapInArrow(run, "term long, n long, toxic long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def choose_terms(rates: DataFrame, total: int, toxic: int) -> np.ndarray:
    """Hashes of the terms that mark toxic documents, at most ``TERMS``, surest first."""
    n, p = F.col("n"), F.col("toxic") / F.col("n")
    z = F.lit(SURE * SURE)
    low = (p + z / (2 * n) - F.sqrt(z) * F.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)
    rate = toxic / max(total, 1)
    picked = (
        rates.where(F.col("term").isNotNull() & (low >= min(LIFT * rate, 0.5)))
        .orderBy((low * F.log1p("toxic")).desc(), "term")
        .limit(TERMS)
    )
    return np.sort(np.array([r["term"] for r in picked.collect()], dtype=np.int64).view(np.uint64))


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """Documents in all, and for each term those that contain it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            n += batch.num_rows
            for part in slices(batch.column(0)):
                df += np.bincount(matches(part, terms)[1], minlength=len(terms))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(-1, at), pa.int32()), pa.array(np.append(n, df[at]), pa.int64())], ["at", "n"]
        )

    counts = docs.select("text").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = (counts.column(c).to_numpy() for c in ("at", "n"))
    df = np.zeros(len(terms), dtype=np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), df


def fit(docs: DataFrame, labelled: DataFrame, label: str) -> Index:
    """Index of a bounded labelled sample (columns doc_id, text, ``label``), weighted by all of ``docs``.

    Without labelled rows, or without terms, every score is the general rate (0.5 where nothing is known).
    """
    rates = term_rates(labelled, label)
    rows = rates.where(F.col("term").isNull()).collect()
    total, toxic = (rows[0]["n"], rows[0]["toxic"]) if rows else (0, 0)
    terms = choose_terms(rates, total, toxic)
    n, df = document_frequencies(docs, terms)
    idf = np.log((n + 1) / (df + 1)) + 1
    rate = (toxic + 0.5) / (total + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                row, at, counts = matches(part, terms)
                lists = np.split(np.arange(len(row)), np.searchsorted(row, np.arange(1, len(part))))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        batch.column(2).slice(part.first, len(part)),
                        pa.array([at[i].tolist() for i in lists], pa.list_(pa.int32())),
                        pa.array([counts[i].tolist() for i in lists], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "y", "at", "counts"],
                )

    vectors = labelled.select(F.col("doc_id").cast("long"), "text", F.col(label).cast("int")).mapInArrow(
        run, "doc_id long, y int, at array<int>, counts array<int>"
    )
    bare = vectors.where(F.size("at") == 0).agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).first()
    bare_rate = ((bare["toxic"] or 0) + 2 * PRIOR * rate) / (bare["n"] + 2 * PRIOR)
    # The neighbours of a common vector are any of its copies, so lowest hashes first is as good as any.
    examples = (
        vectors.where(F.size("at") > 0).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(EXAMPLES).toPandas()
    )
    dense = np.zeros((len(examples), len(terms)))
    for i, (at, counts) in enumerate(zip(examples["at"], examples["counts"])):
        dense[i, at] = weigh(np.asarray(at), np.asarray(counts), idf)
    # Similar examples side by side: by heaviest term, then by its weight.
    order = np.lexsort((-dense.max(axis=1), dense.argmax(axis=1))) if len(terms) else np.arange(0)
    dense = dense[order]
    edges = np.arange(0, len(dense), BLOCK)
    maxima = np.maximum.reduceat(dense, edges, axis=0) if len(dense) else np.zeros((0, len(terms)))
    return Index(
        terms,
        idf,
        dense,
        examples["doc_id"].to_numpy(np.int64)[order],
        examples["y"].to_numpy(np.int64)[order],
        maxima,
        rate,
        bare_rate,
    )


def stresses(terms: np.ndarray, rates: pa.Table, rate: float) -> np.ndarray:
    """How much more each term weighs: 1, and ``STRESS`` for each time its sure toxic rate exceeds the general one.

    ``rates`` has term, n and toxic of the terms in toxic documents at least; of others the sure rate is 0.
    """
    out = np.ones(len(terms))
    if not len(terms) or not len(rates):
        return out
    hashes, n, toxic = (rates.column(c).to_numpy() for c in ("term", "n", "toxic"))
    p, z = toxic / n, SURE * SURE
    low = (p + z / (2 * n) - SURE * np.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)
    hashes = hashes.astype(np.int64).view(np.uint64)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[at] == hashes
    out[at[hit]] += STRESS * np.maximum(low[hit] / rate - 1, 0)
    return out


def fit_words(docs: DataFrame, labelled: DataFrame, label: str) -> WordIndex:
    """Index of all words of a bounded labelled sample (columns doc_id, text, ``label``), weighted by all of ``docs``.

    Without labelled rows every score is the general rate (0.5 where nothing is known).
    """
    rates = term_rates(labelled, label).where("term is null or toxic > 0").toArrow()
    whole = rates.filter(rates.column("term").is_null())
    total, toxic = (whole.column(c)[0].as_py() if len(whole) else 0 for c in ("n", "toxic"))
    rate = (toxic + 0.5) / (total + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                found = words(part, ALNUM)
                order = np.lexsort((found.hashes, found.rows))
                h, rows = found.hashes[order], found.rows[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
                at = np.flatnonzero(new)
                ends = pa.array(np.searchsorted(rows[at], np.arange(len(part) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        batch.column(2).slice(part.first, len(part)),
                        pa.ListArray.from_arrays(ends, pa.array(signed(h[at]), pa.int64())),
                        pa.ListArray.from_arrays(ends, pa.array(np.diff(np.append(at, len(h))), pa.int32())),
                    ],
                    ["doc_id", "y", "hashes", "counts"],
                )

    # Any examples are as good as others; the lowest hashes are taken, without moving texts for it.
    turn = F.xxhash64(F.col("doc_id").cast("long"))
    last = labelled.select(turn.alias("turn")).orderBy("turn").limit(EXAMPLES).agg(F.max("turn")).first()[0]
    chosen = labelled.where(turn <= last).select(F.col("doc_id").cast("long"), "text", F.col(label).cast("int"))
    kept = chosen.mapInArrow(run, "doc_id long, y int, hashes array<long>, counts array<int>")
    examples = kept.toArrow().combine_chunks()
    ids, labels = (examples.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "y"))
    hashes = [np.asarray(x, dtype=np.int64).view(np.uint64) for x in examples.column("hashes").to_numpy()]
    counts = [np.asarray(x, dtype=np.int64) for x in examples.column("counts").to_numpy()]
    terms = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *hashes]))
    n, df = document_frequencies(docs, terms)
    idf = (np.log((n + 1) / (df + 1)) + 1) * stresses(terms, rates.filter(rates.column("term").is_valid()), rate)
    return word_index(terms, idf, [(np.searchsorted(terms, h), c) for h, c in zip(hashes, counts)], ids, labels, rate)


def score(docs: DataFrame, index: Index | WordIndex, text: str = "text") -> DataFrame:
    """Append ``score`` (0 to 1) and ``evidence`` (neighbours with doc_id, label and cosine, nearest first).

    Null and empty texts contain no term of the index: their score is the rate of examples without terms, their
    evidence is empty.  Repeated rows get the same result; other columns are kept (columns named ``score`` or
    ``evidence`` are replaced); an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("score", "evidence")]
    source = docs.select(*kept)
    neighbour = StructType(
        [StructField("doc_id", LongType()), StructField("label", IntegerType()), StructField("cosine", DoubleType())]
    )
    schema = StructType(
        [*source.schema.fields, StructField("score", DoubleType()), StructField("evidence", ArrayType(neighbour))]
    )
    column = kept.index(text)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(column)):
                row, at, counts = matches(part, index.terms)
                scores, evidence = [index.bare_rate] * len(part), [[]] * len(part)
                edges = np.flatnonzero(np.diff(row, prepend=-1))
                for i, j in zip(edges, [*edges[1:], len(row)]):
                    places, cosines = index.nearest(at[i:j], weigh(at[i:j], counts[i:j], index.idf))
                    scores[row[i]] = index.vote(places, cosines)
                    evidence[row[i]] = [
                        {"doc_id": int(index.ids[p]), "label": int(index.labels[p]), "cosine": float(c)}
                        for p, c in zip(places, cosines)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(part.first, len(part)) for c in batch.columns),
                        pa.array(scores, pa.float64()),
                        pa.array(evidence, kind),
                    ],
                    [*kept, "score", "evidence"],
                )

    return source.mapInArrow(run, schema)
