"""Runs: stretches of words that repeat with a period, found with string synchronising sets.

A run with smallest period q and at least four periods is found at the dyadic scale t with t <= q < 2t.  At a
scale, every position has the hash of the t words from it; a position belongs to the synchronising set when the
smallest hash among it and the next t positions stands at its beginning or at its end.  Membership depends on
2t words alone (the context), so equal contexts are chosen alike, and a text has about 2/t positions a word.

Windows whose own period is a quarter of t or less are left out of the minimum, or highly periodic regions
would fill the set.  Those regions are the runs of the smaller scales, which are found before: their periods
are the ones the set omits.  Everywhere else one of any t neighbouring positions is in the set.

So the first t positions of a run hold one of the set, the same context stands q words further, and no equal
context stands between (both would make a smaller period).  Neighbouring equal contexts t to 2t - 1 words apart
therefore propose every period.  A proposal is extended to both sides on the words themselves, once for each run.

Words are numbered exactly; hashes of contexts only propose, so a wrong match proposes in vain (64 bits; it could
hide a proposal only by falling between two equal contexts).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from depotflow.llm.wordhash import mix, slices

#: White space between words, as a pattern of a class.
SPACE = r"[\x20\x09-\x0D]+"

#: Periods that a run has at least.  The synchronising sets are sure to meet runs of four or more.
TIMES = 4

#: Words compared at once at first when a run is extended; doubled as long as they agree.
STEP = 32

_NONE = np.uint64((1 << 64) - 1)


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all rows end to end, a number for each (equal for equal words), and where each row begins."""
    split = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE)
    flat = split.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
    sums = np.concatenate([[0], np.cumsum(real)])
    bounds = sums[np.concatenate([[0], ends]).astype(np.int64)]
    words = flat.filter(pa.array(real))
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return words, ids, bounds


def _shifted(x: np.ndarray, by: int, rest: np.ndarray) -> np.ndarray:
    """x[i + by], beyond the end the values of ``rest``."""
    out = rest.copy()
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def _reach(one: np.ndarray, other: np.ndarray) -> int:
    """Length of the longest common prefix."""
    at, step, n = 0, STEP, min(len(one), len(other))
    one, other = one[:n], other[:n]
    while at < n:
        differ = np.flatnonzero(one[at : at + step] != other[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return n


def _extended(text: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """Start and end of the stretch around ``at`` in which words ``period`` apart are identical."""
    right = _reach(text[at:], text[at + period :])
    left = _reach(text[:at][::-1], text[period : at + period][::-1])
    return at - left, at + right + period


def runs(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start (in the row), length and period of all runs of ``TIMES`` periods or more, by row, start, period.

    ``ids`` are the words of all rows, row i those from ``bounds[i]`` to ``bounds[i + 1]``.
    """
    counts = np.diff(bounds)
    n_rows = len(counts)
    # Every row ends with a word of its own, so nothing repeats across rows.
    row = np.repeat(np.arange(n_rows), counts + 1)
    first = bounds[:-1] + np.arange(n_rows)
    text = np.empty(len(ids) + n_rows, dtype=np.int64)
    last = first + counts
    inside = np.ones(len(text), dtype=bool)
    inside[last] = False
    text[inside] = ids
    text[last] = (int(ids.max()) + 1 if len(ids) else 0) + np.arange(n_rows)

    longest = int(counts.max()) if n_rows else 0
    at = np.arange(len(text))  # positions of rows that are long enough for the scale
    window = np.minimum(mix(text.astype(np.uint64) + np.uint64(1)), _NONE - np.uint64(1))
    found: list[tuple[int, int, int]] = []
    scale, level = 1, 0
    while TIMES * scale <= longest:
        long = counts[row[at]] >= TIMES * scale
        at, window = at[long], window[long]
        own = np.minimum(mix(at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level + 1)), _NONE - np.uint64(1))
        context = mix(window * np.uint64(0xD6E8FEB86659FD93) + mix(_shifted(window, scale, own)) + np.uint64(level))
        context = np.minimum(context, _NONE - np.uint64(1))
        # Windows inside regions of small periods take no part in the minimum.
        key = window
        small = [(s, e) for s, e, p in found if TIMES * p <= scale <= e - s]
        if small:
            steps = np.zeros(len(text) + 1, dtype=np.int64)
            s, e = np.array(small).T
            np.add.at(steps, s, 1)
            np.add.at(steps, e - scale + 1, -1)
            key = np.where(np.cumsum(steps[:-1])[at] > 0, _NONE, window)
        absent = np.full(len(key), _NONE)
        least, width = key, 1
        while width < scale:
            least, width = np.minimum(least, _shifted(least, width, absent)), 2 * width
        least = np.minimum(least, _shifted(key, scale, absent)) if scale == 1 else np.minimum(least, _shifted(least, 1, absent))
        chosen = np.flatnonzero((least != _NONE) & ((least == key) | (least == _shifted(key, scale, absent))))
        # Neighbouring equal contexts propose periods.
        order = chosen[np.argsort(context[chosen], kind="stable")]
        apart = np.diff(order)
        near = (context[order[1:]] == context[order[:-1]]) & (apart >= scale) & (apart < 2 * scale)
        start, period = order[:-1][near], apart[near]
        # The first proposal of a run has two periods more behind it: the window that ends there must recur too.
        beyond = start + 3 * period - scale
        held = beyond < len(window)
        start, period = start[held], period[held]
        held = window[start + 2 * period - scale] == window[start + 3 * period - scale]
        start, period = at[start[held]], period[held]
        order = np.lexsort((start, period))
        known, until = -1, -1
        for s, p in zip(start[order].tolist(), period[order].tolist()):
            if p == known and s < until:
                continue
            begin, end = _extended(text, s, p)
            known, until = p, end - p
            if end - begin >= TIMES * p:
                found.append((begin, end, p))
        window, scale, level = context, 2 * scale, level + 1

    table = np.array(found, dtype=np.int64).reshape(-1, 3)
    begin, end, period = table.T
    of = row[begin]
    order = np.lexsort((period, begin))
    return of[order], (begin - first[of])[order], (end - begin)[order], period[order]


def periodic_runs(df: DataFrame, text: str = "text", least: int = 6, times: int = TIMES) -> DataFrame:
    """Append n_words, runs (array of start, length, period in words, by start and period) and collapsed.

    A run is a maximal stretch of words with smallest period q (words q apart are identical) and a length of
    ``least`` and ``times * q`` or more; ``times`` is four at least.  ``collapsed`` holds the words that no run
    contains after its first q words, joined by a space.  Other columns are kept; those of these names are replaced.

    A null or empty text, or one of white space, has no words, no runs and an empty ``collapsed``.  Every row is
    judged alone: repeated rows give equal rows, an empty table an empty one.  A text of any length is one row of
    one task, with about fifteen numbers a word in memory.
    """
    if times < TIMES or least < 1:
        raise ValueError(f"times must be {TIMES} or more, least 1 or more")
    kept = [c for c in df.columns if c not in ("n_words", "runs", "collapsed")]
    source = df.select(*kept, F.col(text).cast("string").alias("collapsed"))
    span = StructType().add("start", "long").add("length", "long").add("period", "long")
    schema = StructType(source.schema.fields[:]).add("n_words", LongType()).add("runs", ArrayType(span))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept))
            for part in slices(texts):
                words, ids, bounds = numbered(texts.slice(part.first, len(part)))
                of, start, length, period = runs(ids, bounds)
                meant = length >= np.maximum(least, times * period)
                of, start, length, period = of[meant], start[meant], length[meant], period[meant]
                repeated = np.zeros(len(ids) + 1, dtype=np.int64)
                np.add.at(repeated, bounds[of] + start + period, 1)
                np.add.at(repeated, bounds[of] + start + length, -1)
                stays = np.cumsum(repeated[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(stays)])[bounds]
                collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(stays)).cast(pa.string())), " ")
                ends = np.searchsorted(of, np.arange(len(part) + 1))
                structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(part.first, len(part)) for c in range(len(kept))),
                        collapsed,
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    ],
                    [*kept, "collapsed", "n_words", "runs"],
                )

    return source.mapInArrow(run, schema).select(*kept, "n_words", "runs", "collapsed")
