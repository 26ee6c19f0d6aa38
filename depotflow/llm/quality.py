"""Document quality by regularised quadratic discriminant analysis.

Statistics of a document's characters and words are transformed to roughly normal scale.  Each class has
a mean and a covariance shrunk towards its own and the pooled variances.  A score is the logistic of the difference of the two log densities plus the log of the class ratio; the densities come
from Mahalanobis distances with Cholesky factors that are computed once.

Training folds documents into sums and sums of products per class, so what reaches the driver is a few
kilobytes whatever the number of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from depotflow.llm.wordhash import NOT_SPACE, Slice, slices, words

#: Words of a window for the statistics that look for the worst part of a text.
WINDOW = 24

#: Statistics of a document.
SIZE = 16

#: Added to every standardised variance.
RIDGE = 1e-3

#: Labelled documents to fit on at most.
SAMPLE = 20_000


def _class(characters: str) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[[ord(c) for c in characters]] = True
    return found


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True
_CASED = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _class("0123456789")
_SENTENCE = _class(".,;:?'\"-()")
_SYMBOL = _class("!#$%&*+/<=>@[\\]^_`{|}~")
_HEAD = np.ones(256, dtype=bool)  # first byte of a character
_HEAD[128:192] = False


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, dtype=np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Share on a log-odds scale, with half a count added on each side."""
    return np.log((count + 0.5) / (np.maximum(total - count, 0) + 0.5))


def _worst(flags: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Largest share of flagged words in any window; a shorter text is one window."""
    sums = _sums(flags)
    n = len(counts)
    out = np.zeros(n)
    full = np.maximum(counts - WINDOW + 1, 1) * (counts > 0)
    rows = np.repeat(np.arange(n), full)
    if len(rows):
        firsts = np.concatenate([[0], np.cumsum(full)[:-1]])
        at = bounds[:-1][rows] + np.arange(len(rows)) - firsts[rows]
        width = np.minimum(counts, WINDOW)[rows]
        np.maximum.at(out, rows, (sums[at + width] - sums[at]) / width)
    return out


def statistics(part: Slice) -> np.ndarray:
    """Transformed statistics of each row of a slice; an empty text has those of no words."""
    byte, edges = part.data, part.offsets
    count = lambda flags: np.diff(_sums(flags[byte])[edges])
    chars = count(_HEAD)
    found = words(part, NOT_SPACE)
    n = found.counts
    last = byte[found.ends - 1] if len(found.ends) else byte[:0]
    per_word = lambda flags: (s := _sums(flags[byte]))[found.ends] - s[found.starts]
    in_row = lambda flags: np.diff(_sums(flags)[found.bounds])
    letters, cased, uppers = per_word(_LETTER), per_word(_CASED), per_word(_UPPER)
    loud = (uppers >= 2) & (uppers == cased)
    marked = _SYMBOL[last]
    bare = letters == 0
    same = np.zeros(len(found.hashes), dtype=bool)
    same[1:] = found.hashes[1:] == found.hashes[:-1]
    inner = found.bounds[:-1][(found.bounds[:-1] < len(same)) & (n > 0)]
    same[inner] = False
    order = np.lexsort((found.hashes, found.rows))
    sorted_hashes = found.hashes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    new[inner] = True
    distinct = in_row(new)
    width = per_word(_HEAD)
    squared = np.diff(np.concatenate([[0.0], np.cumsum(width.astype(float) ** 2)])[found.bounds])
    total = np.diff(_sums(width)[found.bounds])
    mean = total / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(squared / np.maximum(n, 1) - mean**2, 0))
    return np.column_stack(
        [
            np.log1p(chars),
            np.log1p(mean),
            np.log1p(spread),
            _share(count(_UPPER), count(_CASED)),
            _share(count(_DIGIT), chars),
            _share(count(_SENTENCE), chars),
            _share(count(_SYMBOL), chars),
            _share(in_row(marked), n),
            _share(in_row(bare), n),
            _share(in_row(loud), n),
            _share(in_row(same), n),
            np.log((distinct + 1) / (n + 1)),
            np.sqrt(_worst(marked, n, found.bounds)),
            np.sqrt(_worst(bare, n, found.bounds)),
            np.sqrt(_worst(loud, n, found.bounds)),
            np.sqrt(_worst(same, n, found.bounds)),
        ]
    )




@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors and log determinants of the two classes, and the log class ratio."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    log_odds: float

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """Log of the odds that rows of statistics belong to class 1."""
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            d = np.linalg.solve(factor, (z - mean).T)
            density.append(-0.5 * ((d * d).sum(axis=0) + log_det))
        return density[1] - density[0] + self.log_odds


def _moments(x: np.ndarray) -> np.ndarray:
    """Count, sums and sums of products."""
    return np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])


def fold_classes(labelled: DataFrame, label: str, text: str = "text") -> DataFrame:
    """One row per task and class with the moments of its documents' statistics.

    Rows whose label is neither 0 nor 1 are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(0)):
                x = statistics(part)
                of = y[part.first : part.first + len(part)]
                for c in (0, 1):
                    total[c] += _moments(x[of == c])
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["class", "moments"]
        )

    rows = labelled.where(F.col(label).isin(0, 1)).select(F.col(text), F.col(label).cast("int"))
    return rows.mapInArrow(run, "class int, moments array<double>")


def fit(labelled: DataFrame, label: str, text: str = "text") -> Discriminant:
    """Fit on all labelled rows.  A class without rows takes the mean and covariance of all rows."""
    folded = fold_classes(labelled, label, text)
    places = folded.select("class", F.posexplode("moments").alias("place", "value"))
    sums = places.groupBy("class", "place").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    total[sums["class"], sums["place"]] = sums["value"]
    return discriminant(total)


def discriminant(total: np.ndarray) -> Discriminant:
    """Means and shrunk covariances from the moments of both classes.

    The covariance of n documents gets the weight n / (n + size) against its own variances, which in turn
    get it against the pooled ones, so a class of few documents stays well conditioned.
    """
    count = total[:, 0]
    everything = total.sum(axis=0)
    if not everything[0]:
        everything[0] = 1

    def normal(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean = row[1 : 1 + SIZE] / row[0]
        return mean, row[1 + SIZE :].reshape(SIZE, SIZE) / row[0] - np.outer(mean, mean)

    centre, pooled = normal(everything)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    means, factors, log_dets = [], [], []
    for row in total:
        mean, covariance = normal(row if row[0] else everything)
        mean, covariance = (mean - centre) / scale, covariance / np.outer(scale, scale)
        weight = row[0] / (row[0] + SIZE)
        variances = weight * np.diag(covariance) + (1 - weight)
        shrunk = weight * covariance + (1 - weight) * np.diag(variances) + RIDGE * np.eye(SIZE)
        factor = np.linalg.cholesky(shrunk)
        means.append(mean)
        factors.append(factor)
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    log_odds = float(np.log((count[1] + 1) / (count[0] + 1)))
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(log_dets), log_odds)


def score(docs: DataFrame, model: Discriminant, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability of class 1.

    Null texts count as empty; empty texts have the statistics of no words and get a score as any other.
    All columns and repeated rows are kept (a column named ``out`` is replaced); an empty table stays empty.
    """

    kept = [c for c in docs.columns if c != out]
    source = docs.select(*kept)
    column = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(column)):
                ratio = np.clip(model.log_ratio(statistics(part)), -500, 500)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(part.first, len(part)) for c in batch.columns),
                        pa.array(1 / (1 + np.exp(-ratio)), pa.float64()),
                    ],
                    [*kept, out],
                )

    return source.mapInArrow(run, StructType([*source.schema.fields, StructField(out, DoubleType())]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, kept, most: int = SAMPLE) -> DataFrame:
    """Texts and labels of at most ``most`` labelled documents, those whose ids hash lowest.

    ``kept`` is a condition on doc_id for rows that may be learned from.  Only rows with label 0 or 1
    count; a document that is labelled several times takes the smallest label.  The sample's size is
    bounded, so it is broadcast.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & kept)
        .groupBy("doc_id")
        .agg(F.min(label).alias(label))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", label)


def in_fold(doc_id: str, folds: int, fold: int):
    """crc32 of the id as text, modulo ``folds``, is ``fold``; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))
