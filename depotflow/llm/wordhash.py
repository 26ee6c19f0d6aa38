"""Words and word-sequence hashes of whole columns of text, vectorised over UTF-8 bytes.

Every function takes the bytes of several documents laid end to end with their offsets, so one
numpy call serves hundreds of documents.  A slice holds ``SLICE_BYTES`` of text at most (a longer
document comes alone), which bounds the memory of a task whatever the batch size of Arrow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(64)], dtype=np.uint64)


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte; A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
    values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = _byte_values()

#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z: digits, letters, non-ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(n, SLICE_BYTES)
        factors = np.full(size, _MULTIPLIER if kind == "up" else _INVERSE, dtype=np.uint64)
        factors[0] = 1
        _powers[kind] = np.multiply.accumulate(factors)
    return _powers[kind][:n]


@dataclass
class Slice:
    """Bytes of consecutive rows; row i has ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield Slice(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


@dataclass
class Words:
    """Words of a slice: byte ranges, hashes (case of A-Z ignored), and where each row's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(part: Slice, letters: np.ndarray) -> Words:
    """Maximal runs of the given bytes within each row."""
    inside = letters[part.data]
    n = len(inside)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(part.offsets), dtype=np.int64))
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    edges = part.offsets[:-1]
    before[edges[edges < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    after[(edges - 1)[edges > 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[part.data] * _power("up", n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power("down", n)[starts])
    return Words(starts, ends, hashes, np.searchsorted(starts, part.offsets))


def grams(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word sequences within rows, and where each row's sequences begin."""
    counts = np.maximum(np.diff(bounds) - k + 1, 0)
    starts = np.concatenate([[0], np.cumsum(counts)])
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), starts
    total = hashes[:n] * _GRAM[0]
    for j in range(1, k):
        total += hashes[j : n + j] * _GRAM[j]
    rows = np.repeat(np.arange(len(counts)), counts)
    at = bounds[:-1][rows] + np.arange(starts[-1]) - starts[:-1][rows]
    return mix(total[at] + np.uint64(k)), starts


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return hashes.view(np.int64)
