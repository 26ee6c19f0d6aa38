"""Byte-pair encoding and decoding with a given byte-level vocabulary.

Merges run on a doubly linked list of symbols.  A heap holds the rank and place of every adjacent pair
that can merge; an entry whose pair has changed meanwhile is stale and skipped.  Decoding concatenates
the vocabulary's byte strings.

Words, and pieces between single spaces, repeat all over a corpus, so each Python worker keeps the ids of
those it has met, up to fixed counts; the counts bound memory only, never the result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

#: Fixed value: the published splitting pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces and words that a task keeps at most.
KEPT_PIECES, KEPT_WORDS = 100_000, 250_000

#: Rows of a batch that goes back to Spark.
ROWS_OUT = 128


def byte_characters() -> dict[str, int]:
    """Character of each byte in the vocabulary file: printable Latin-1 as it is, others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Kept(dict):
    """Packed ids by string; a missing string is encoded, and kept while there is room."""

    def __init__(self, encode, most: int, prefix: str = "") -> None:
        super().__init__()
        self.encode, self.most, self.prefix = encode, most, prefix

    def __missing__(self, text: str) -> bytes:
        found = self.encode(self.prefix + text)
        if len(self) < self.most:
            self[text] = found
        return found


class ByteBpe:
    """Encoder and decoder for a vocabulary file in the JSON form of byte-level BPE."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        of = byte_characters()
        size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        self.strings: list[bytes] = [b""] * size
        for text, i in vocabulary.items():
            self.strings[i] = bytes(map(of.get, text))
        self.bytes = [0] * 256
        for c, b in of.items():
            self.bytes[b] = vocabulary[c]
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault((vocabulary[a], vocabulary[b]), rank)
            self.made.append(vocabulary[a + b])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.added.items():
            self.strings[i] = text.encode()
        self.split_added = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )
        self.pattern = regex.compile(PATTERN)
        self.odd_space = re.compile(r" \s|\s ")
        self.lone_space = regex.compile(r"(?<=\S) (?=\S)")
        self.words = _Kept(self._word, KEPT_WORDS)
        self.first = _Kept(self._piece, KEPT_PIECES // 10)
        self.later = _Kept(self._piece, KEPT_PIECES, " ")

    def merged(self, data: bytes) -> list[int]:
        """Ids of one word."""
        symbols = list(map(self.bytes.__getitem__, data))
        n, rank = len(symbols), self.ranks.get
        heap = [r << 32 | i for i, p in enumerate(zip(symbols, symbols[1:])) if (r := rank(p)) is not None]
        if not heap:
            return symbols
        heapify(heap)
        after, before, made = list(range(1, n + 1)), list(range(-1, n - 1)), self.made
        symbols.append(-1)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if rank((symbols[i], symbols[j])) != top >> 32:
                continue  # the pair is gone
            symbols[i] = left = made[top >> 32]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank((left, symbols[k]))
                if r is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = rank((symbols[h], left))
                if r is not None:
                    heappush(heap, r << 32 | h)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        ids = self.merged(word.encode("utf-8"))
        return pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.pattern.findall(piece)))

    def _plain(self, text: str) -> bytes:
        # A space between two visible characters always opens a word, so pieces between such spaces
        # encode on their own.
        pieces = self.lone_space.split(text) if self.odd_space.search(text) else text.split(" ")
        return self.first[pieces[0]] + b"".join(map(self.later.__getitem__, pieces[1:]))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split_added is None or not any(t in text for t in self.added):
            return self._plain(text)
        out = []
        for part in self.split_added.split(text):
            i = self.added.get(part)
            out.append(self._plain(part) if i is None else pack("<I", i))
        return b"".join(out)

    def forget(self) -> None:
        """Drop the pieces and words of the texts seen so far; the vocabulary stays."""
        for kept in (self.words, self.first, self.later):
            kept.clear()

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Append ``ids`` (packed little-endian unsigned 32-bit) and ``decoded`` (text of the ids).

    Null and empty texts have no ids and decode to the empty text.  Repeated rows stay; other columns are
    kept (columns named ``ids`` or ``decoded`` are replaced).  An empty table gives an empty result.
    ``path`` is the vocabulary file, which every executor must be able to open.
    """
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    source = docs.select(*kept)
    schema = StructType([*source.schema.fields, StructField("ids", BinaryType()), StructField("decoded", StringType())])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_OUT):
                    part = batch.slice(start, ROWS_OUT)
                    ids = [bpe.encode(t or "") for t in part.column(at).to_pylist()]
                    decoded = pa.array([bpe.decode(i) for i in ids], pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(ids, pa.binary()), decoded], [*kept, "ids", "decoded"]
                    )
        finally:
            bpe.forget()  # Spark keeps the worker for the tasks of other operators

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_decode(docs.select("doc_id", "text"), path).select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
