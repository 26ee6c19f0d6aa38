"""Corpus pipeline: quality, toxicity, near duplicates, benchmark decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's documents.  All but the last return the columns of documents, and a stage drops what its
operator rejects and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotflow.llm import byte_bpe, decontamination, ngram_jaccard, quality, toxicity
from depotflow.llm.queries import table, vocabulary
from depotflow.llm.tables import Scratch, row_key

#: Probability of good quality from which a document stays, and of toxicity from which it goes.
GOOD, TOXIC = 0.7, 0.5

#: Most rows, and bytes, of a batch that goes to Python.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """Lower the session's Arrow batches, if they are larger, before the stage plans its work.

    All stages run in the same Python workers, and these keep what the largest batch of any stage needed, beside
    what the JVM holds to send it.  The setting stays, for a stage's result is written after it returns.
    """
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
            spark.conf.set(rows, BATCH_ROWS)
        spark.conf.set(size, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = table(spark, sf_dir, "labels")
    known = quality.labelled_sample(docs, labels, "quality", ~quality.in_fold("doc_id", 4, 2))
    scored = quality.score(docs, quality.fit(known, "quality"), out="quality_score")
    return scored.where(F.col("quality_score") >= GOOD).select(*docs.columns)


@in_small_batches
def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts."""
    labels = table(spark, sf_dir, "labels")
    known = quality.labelled_sample(docs, labels, "toxic", ~quality.in_fold("doc_id", 5, 0))
    scored = toxicity.score(docs, toxicity.fit_words(docs, known, "toxic"))
    return scored.where(F.col("score") < TOXIC).select(*docs.columns)


@in_small_batches
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, and one of repeated rows.

    A row is decided by its own text, whatever other rows share its id.  Rows with a null id stay, one of
    repeated ones; they do not speak for their group, so the smallest id of it stays too.
    """
    found = ngram_jaccard.near_copies(docs, keyed=True)
    copies = found.where(F.col("doc_id") != F.col("component_id")).select("key_a", "key_b").distinct()
    keyed = docs.select("*", *row_key("doc_id", "text"))
    # Joining and removing repeats need one exchange of the texts, by row key.
    kept = keyed.join(copies, ["key_a", "key_b"], "left_anti").dropDuplicates(["key_a", "key_b"])
    return kept.select(*docs.columns)


@in_small_batches
def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark passages.

    A row is decided by its own text: a contaminated one goes also with a null id, and one that shares its id
    with a contaminated one stays.
    """
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), keyed=True)
    spoiled = found.where("contaminated").select("key_a", "key_b").distinct()
    keyed = docs.select("*", *row_key("doc_id", "text"))
    return keyed.join(spoiled, ["key_a", "key_b"], "left_anti").select(*docs.columns)


@in_small_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-pair ids of every remaining document, as counts and digests."""
    return byte_bpe.digests(docs, vocabulary())


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("BPE encoding and decoding", token_ids),
]

#: Classifiers and similarity joins have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents.

    Each result but the last is written once to the shared folder; the one before goes when the next is there.
    """
    docs, scratch, last = table(spark, sf_dir, "documents"), Scratch(spark), None
    for name, stage in STAGES[:-1]:
        what = name.replace(" ", "-")
        docs = scratch.put(stage(spark, docs, sf_dir), what)
        if last:
            scratch.drop(last)
        last = what
    return STAGES[-1][1](spark, docs, sf_dir)
