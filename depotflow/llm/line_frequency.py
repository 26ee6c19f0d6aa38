"""Cross-document line frequency: lines that many documents of a host share are removed, depleted documents go.

DataFrame functions only.  One pass over the texts makes a narrow row for each document: counts, and for every
distinct line the hash of its normalised form with the characters that it holds.  Lines are counted by host over these
rows (partial counts on the map side, so a line in every document costs a row a task), those above the limit are
joined back, and what is left of a document decides.

A host with a third of all documents is spread over its lines' hashes.  Only a line of many documents would make a
hot key in the join back.  The lines in ``1 / HOT_LINES`` of all entries or more are ``HOT_LINES`` at most, so they are
broadcast; every other line has fewer entries than that and is joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.llm.tables import Scratch

#: White space, as characters and as the class of a pattern.
BLANKS, BLANK = " \t\n\x0b\x0c\r", r"\x20\x09-\x0D"

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Documents of a host that may share a line, and percent of its characters in words that a document must keep.
MOST_DOCUMENTS, LEAST_LEFT = 10, 50

#: Lines at most that are broadcast, and the part of all entries that such a line has.
HOT_LINES = 10_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_line(line: Column) -> Column:
    """A-Z in lower case, white space trimmed and each stretch of it one space."""
    return F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), f"[{BLANK}]+", " "))


def solid_chars(text: Column) -> Column:
    """Code points that are not white space: those inside words."""
    return F.char_length(F.translate(text, BLANKS, ""))


def repeated_words(docs: DataFrame, words: str, out: str, window: int = 3) -> DataFrame:
    """Append ``out``: how many of the ``words`` (an array) lie in ``window`` consecutive ones found twice or more.

    Windows are sorted by hash (64 bits) with their places, so equal ones are neighbours and nothing is compared
    with all others, whatever the length of the text.
    """
    n = F.greatest(F.size(words) - (window - 1), F.lit(0))
    parts = F.arrays_zip(*[F.slice(words, i + 1, n) for i in range(window)])
    placed = F.array_sort(F.transform(parts, lambda w, i: F.struct(F.xxhash64(w).alias("h"), i.alias("i"))))
    docs = docs.withColumn("_placed", placed)
    later = F.slice("_placed", 2, F.greatest(F.size("_placed"), F.lit(1)))
    pairs = F.zip_with("_placed", later, lambda one, other: F.when(one["h"] == other["h"], F.array(one["i"], other["i"])))
    places = F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    docs = docs.withColumn("_places", places).drop("_placed")
    later = F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1)))
    steps = F.zip_with("_places", later, lambda one, other: F.least(other - one, F.lit(window)))
    return docs.withColumn(out, F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)).drop("_places")


def text_counts(docs: DataFrame, host: str, text: str) -> DataFrame:
    """Per row: row, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and lines.

    ``lines`` has (key, chars) of every line with a word; the key hashes host and normalised line, nulls apart.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.col(host).alias("host"), body.alias("body"))
    words = F.regexp_extract_all("body", F.lit(f"[^{BLANK}]+"), F.lit(0))
    lines = F.filter(F.split("body", "\n"), lambda line: F.translate(line, BLANKS, "") != "")
    split = named.withColumns({"words": words, "all_lines": lines})
    split = repeated_words(split, "words", "n_repeat_words")
    key = lambda line: F.xxhash64(F.col("host").isNull(), "host", normal_line(line))
    return split.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        solid_chars(F.col("body")).cast("long").alias("word_chars"),
        (F.char_length("body") - F.char_length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("all_lines") - F.size(F.array_distinct("all_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform("all_lines", lambda line: F.struct(key(line).alias("key"), solid_chars(line).alias("chars"))).alias("lines"),
    )


def frequent_lines(counts: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """(key, documents) of the lines in more than ``most`` documents of their host.

    A row counts a line once, so counting rows counts documents.
    """
    own = F.array_distinct(F.transform("lines", lambda line: line["key"]))
    return counts.select(F.explode(own).alias("key")).groupBy("key").agg(F.count("*").alias("documents")).where(F.col("documents") > most)


def removed_lines(counts: DataFrame, frequent: DataFrame, n_entries: int, hot: int = HOT_LINES) -> DataFrame:
    """(row, n_removed_lines, removed_chars) of the rows that have a frequent line."""
    entries = counts.select("row", F.explode("lines").alias("line")).select("row", "line.key", "line.chars")
    is_hot = F.col("documents") * hot >= n_entries
    # At most ``hot`` lines can be in that part of all entries.
    widest = F.broadcast(frequent.where(is_hot).select("key", F.lit(True).alias("hot")))
    entries = entries.join(widest, "key", "left")
    rest = entries.where("hot is null").join(frequent.where(~is_hot).select("key"), "key")
    found = entries.where("hot").select("row", "chars").unionByName(rest.select("row", "chars"))
    return found.groupBy("row").agg(F.count("*").alias("n_removed_lines"), F.sum("chars").alias("removed_chars"))


def line_rules(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    most_documents: int = MOST_DOCUMENTS,
    least_left: int = LEAST_LEFT,
    hot_lines: int = HOT_LINES,
) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_lines, left_chars, depleted.

    Words are stretches of anything but white space.  ``n_dup_lines`` counts the lines with a word that equal an earlier
    one, ``n_repeat_words`` the words in three consecutive ones found twice or more in the text.  A line is removed
    when more than ``most_documents`` documents of its host hold it, normalised; ``left_chars`` are the characters in
    words of the others, and a document is depleted when they are under ``least_left`` percent of all.

    A null host is a host of its own, apart from the empty name.  A null or empty text has no words and no lines and is
    not depleted.  Every row is a document: repeated rows, and rows with one doc_id or a null one, give a row each and
    count each.  An empty table gives an empty one; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    counts = scratch.put(text_counts(docs, host, text), "counts")
    frequent = scratch.put(frequent_lines(counts, most_documents), "frequent")
    n_entries = counts.agg(F.sum(F.size("lines"))).first()[0] or 0
    removed = scratch.put(removed_lines(counts, frequent, n_entries, hot_lines), "removed")
    left = F.col("word_chars") - F.coalesce("removed_chars", F.lit(0))
    return counts.drop("lines").join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("n_removed_lines", F.lit(0)).alias("n_removed_lines"), left.alias("left_chars"),
        (left * 100 < F.col("word_chars") * least_left).alias("depleted"),
    )
