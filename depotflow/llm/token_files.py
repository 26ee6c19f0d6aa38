"""Token counts of documents in flat, unindexed token files.

A token file holds the ids of many documents one after another, each ended by an end-of-document id; nothing
says where a document begins.  Files are cut into blocks that are read apart; a vectorised search finds the
separators of a block.  A document may span many blocks, so a document's length is the distance between
neighbouring separators across blocks: each block needs the number of separators before it and the place of
the last one.  A prefix scan gives both: blocks are scanned in runs, the runs' totals in each file, and then
both are added, so no task gets all blocks of a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a block, and blocks of a run.
BLOCK_BYTES, RUN = 4 << 20, 1024


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a path as Spark writes it (``file:/x``, ``hdfs://…``, ``s3a://…``)."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if "://" in path else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, folder: str, encode, end: int, dtype: str = "uint16") -> DataFrame:
    """Write the ids of (doc_id, text), one file for each partition; returns the plan of (file, ordinal, doc_id).

    The files are written when the result is, and each is renamed into place once complete, so a task that
    runs twice leaves one file.  ``encode`` maps a list of texts to lists of ids, none of which may be ``end``.
    A null text has no ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, where = _opened(folder)
        system.create_dir(where, recursive=True)
        name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
        draft, n = f"{where}/_draft-{uuid.uuid4().hex}", 0
        with system.open_output_stream(draft) as out:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    for ids in encode([t or "" for t in part.column(1).to_pylist()]):
                        ids = np.asarray(ids, dtype=np.int64)
                        if (ids == end).any():
                            raise ValueError("a text has the end-of-document id among its ids")
                        out.write(np.append(ids, end).astype(dtype).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * part.num_rows, pa.string()),
                            pa.array(range(n, n + part.num_rows), pa.int64()),
                            part.column(0),
                        ],
                        ["file", "ordinal", "doc_id"],
                    )
                    n += part.num_rows
        system.move(draft, f"{where}/{name}")

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "file string, ordinal long, doc_id long")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and bytes of the token files in a folder (names ending in .bin)."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    return listed.select("path", "length")


def separators(files: DataFrame, end: int, dtype: str = "uint16", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per block of (path, length): path, block, tokens before and in it, and the separators' places in it."""
    width = np.dtype(dtype).itemsize
    step = max(block_bytes // width, 1) * width
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / step) - 1)).alias("block"))
    blocks = blocks.where("length > 0").select(
        "path", "length", F.col("block").cast("long"), (F.col("block") * step).cast("long").alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, block, start in zip(*(c.to_pylist() for c in batch.columns)):
                if length % width:
                    raise ValueError(f"{path} has {length} bytes, which is no multiple of {width}")
                system, where = _opened(path)
                with system.open_input_file(where) as f:
                    tokens = np.frombuffer(f.read_at(min(step, length - start), start), dtype=dtype)
                found = np.flatnonzero(tokens == end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]),
                        pa.array([block], pa.int64()),
                        pa.array([start // width], pa.int64()),
                        pa.array([len(tokens)], pa.int64()),
                        pa.array([found.tolist()], pa.list_(pa.int64())),
                    ],
                    ["path", "block", "first", "tokens", "found"],
                )

    spread = blocks.repartition(F.col("path"), F.col("block"))
    return spread.mapInArrow(run, "path string, block long, first long, tokens long, found array<long>")


def count_tokens(files: DataFrame, end: int, dtype: str = "uint16", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: path, ordinal in its file, first_token (place in the file), n_tokens (separator excluded).

    Two separators in a row enclose a document without tokens.  Tokens behind a file's last separator are a
    document if there are any.  Empty files have no documents; an empty list of files gives an empty result.
    A file whose bytes are no multiple of the id width is an error.
    """
    found = separators(files, end, dtype, block_bytes)
    block = found.select(
        "path",
        "block",
        F.floor(F.col("block") / RUN).alias("run"),
        "found",
        "first",
        F.size("found").cast("long").alias("n"),
        # The place behind the block's last separator, in the file.
        F.when(F.size("found") > 0, F.col("first") + F.array_max("found") + 1).alias("last"),
        (F.col("first") + F.col("tokens")).alias("stop"),
    )
    runs = block.groupBy("path", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("stop").alias("stop"))
    over_file = Window.partitionBy("path").orderBy("run")
    earlier = over_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    runs = runs.select(
        "path",
        "run",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("run_ordinal"),
        F.coalesce(F.max("last").over(earlier), F.lit(0)).alias("run_begin"),
        F.max("stop").over(whole).alias("file_stop"),
    )
    inner = Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    block = block.select(
        "path", "run", "found", "first", "stop", "n",
        F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("block_ordinal"),
        F.max("last").over(inner).alias("block_begin"),
    ).join(runs, ["path", "run"])
    begin = F.coalesce("block_begin", "run_begin")
    ends = F.transform("found", lambda i: i + F.col("first"))
    # A document reaches from behind one separator to the next; the last begin of a block has no end in it.
    begins = F.concat(F.array(begin), F.transform("found", lambda i: i + F.col("first") + 1))
    reach = F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("first_token"), e.alias("end")))
    one = block.select(
        "path", (F.col("run_ordinal") + F.col("block_ordinal")).alias("before"), "stop", "file_stop",
        F.posexplode(reach).alias("at", "d"),
    ).select("path", (F.col("before") + F.col("at")).alias("ordinal"), "d.first_token", "d.end", "stop", "file_stop")
    # Tokens behind the last separator of a file come along with its last block.
    open_end = (F.col("stop") == F.col("file_stop")) & (F.col("stop") > F.col("first_token"))
    one = one.where(F.col("end").isNotNull() | open_end)
    return one.select(
        "path", "ordinal", "first_token", (F.coalesce("end", "stop") - F.col("first_token")).alias("n_tokens")
    )


def tiktoken_encoder(path: str):
    """Function from texts to ids, for a vocabulary file of ranks; special strings are ordinary text."""

    def encode(texts: list[str]) -> list[list[int]]:
        encoding = _ENCODINGS.get(path)
        if encoding is None:
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            encoding = _ENCODINGS[path] = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        return [encoding.encode_ordinary(t) for t in texts]

    return encode


#: Encodings that a worker has loaded.
_ENCODINGS: dict[str, object] = {}
