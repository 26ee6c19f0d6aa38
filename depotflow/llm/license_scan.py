"""License scan: exact set-similarity join of text blocks with license templates, DataFrame functions only.

A block matches a template when it holds the given share of the template's distinct words (containment).
Words are ordered by the number of documents that contain them, rarest first.  A template is indexed by its
first |T| - o + 1 words, o being the overlap it needs: a match has one of them.  A block's word at place j
joins a template's word at place i only if the block has o words, and min(|T| - i, |B| - j) of the words from
there on can reach o.  Candidates are then verified.

Only words of templates can be shared, so a block's list holds those alone.  Whole documents are joined
first; a block is a line (or also a window of words across line ends), and a document's blocks are searched for
the templates that the document itself contains.  Phrases are templates that must be contained in full; their places follow from the words.

The templates are a parameter, so their index is small whatever the number of documents, and is broadcast.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.llm.tables import row_key, stored

#: Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Usual wordings of license notices, by label.
TEMPLATES = {
    "notice-mit": "Released under the MIT License",
    "notice-apache": "Licensed under the Apache License, Version 2.0",
    "notice-gpl": "This work is licensed under the GNU General Public License, version 3",
    "notice-cc": "Licensed under CC BY-NC 4.0",
    "text-mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "text-bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "text-gpl": "This program is free software: you can redistribute it and/or modify it under the terms of",
    "reserved": "All rights reserved",
}

#: Share of a template's words that a line must have.
CONTAINED = 0.8

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _template_words(text: str) -> list[str]:
    import re

    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _UPPER.lower())))


def _strings(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def _places(words: Column, phrase: list[str]) -> Column:
    """Starts of all places where the phrase's words stand consecutively."""
    starts = F.when(F.size(words) >= len(phrase), F.sequence(F.lit(0), F.size(words) - len(phrase)))

    def stands(i):
        same = F.lit(True)
        for j, word in enumerate(phrase):
            same = same & (F.get(words, i + j) == word)
        return same

    return F.filter(F.coalesce(starts, F.array().cast("array<int>")), stands)


def _best_line(lines: Column, words: list[str]) -> Column:
    """Largest share of the words that one line has."""
    return F.array_max(F.transform(lines, lambda line: F.size(F.array_intersect(_strings(words), line)))) / len(words)


def _best_window(text: Column, words: list[str], length: int) -> Column:
    """Largest share of the words that ``length`` consecutive words of the text have."""
    own = _strings(words)
    starts = F.filter(F.transform(text, lambda w, i: F.when(F.array_contains(own, w), i + 1)), lambda i: i.isNotNull())
    return F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(own, F.slice(text, i, length))))) / len(words)


def scan(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
    contained: float = CONTAINED,
    across_lines: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, matches, score.

    ``docs`` has doc_id and text; other columns are ignored.  ``n_base`` counts the places of all phrases,
    ``first_word`` and ``last_word`` are the smallest and largest start (null without).  ``labels`` are
    those of phrases and templates, distinct, sorted, joined by commas; ``matches`` lists templates with their
    best containment.  ``score`` is the best containment of a template, and 1 with a phrase.  Null and empty
    texts match nothing.  Repeated rows give a row each; an empty table stays empty.

    With ``across_lines`` windows of the text's words count as blocks too, so wrapped notices are found.  A window
    has as many words as the template and a quarter more (1 / ``contained`` times as many).
    """
    spark = docs.sparkSession
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    sets = [(label, _template_words(text), 1.0, True) for text, label in phrases.items()]
    sets += [(label, _template_words(text), contained, False) for label, text in templates.items()]
    vocabulary = sorted({w for _, words, _, _ in sets for w in words})

    body = docs.select(*row_key("doc_id", "text"), "doc_id", lowered(F.col("text")).alias("body"))
    body = body.withColumn("words", words_of(F.col("body")))
    shared = F.array_intersect("words", _strings(vocabulary))
    found = body.select(F.explode(shared).alias("word")).groupBy("word").count().collect()  # template words only
    frequency = {r["word"]: r["count"] for r in found}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    index = []
    for t, (label, words, share, phrase) in enumerate(sets):
        own = sorted(set(words), key=rank.get)
        need = ceil(share * len(own) - 1e-9)
        index += [(w, t, i, len(own), need) for i, w in enumerate(own[: len(own) - need + 1])]
    firsts = sorted({row[0] for row in index})

    # Template words by rank: filtering the ordered vocabulary orders every document's list.
    rows = body.select(
        "key_a", "key_b", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.array_intersect(_strings(order), "words").alias("block"),
        F.when(F.arrays_overlap("words", _strings(firsts)), F.col("body")).alias("body"),
    )
    rows = stored(rows, "license-rows")

    prefixes = spark.createDataFrame(index, "word string, template int, i int, length int, need int")
    blocks = rows.where("body is not null").dropDuplicates(["key_a", "key_b"])
    probes = blocks.select("key_a", "key_b", F.size("block").alias("size"), F.posexplode("block").alias("j", "word"))
    reach = F.least(F.col("length") - F.col("i"), F.col("size") - F.col("j")) >= F.col("need")
    candidates = (
        probes.where(F.col("word").isin(*firsts))
        .join(F.broadcast(prefixes), "word")
        .where((F.col("size") >= F.col("need")) & reach)
        .groupBy("key_a", "key_b")
        .agg(F.collect_set("template").alias("templates"))
    )
    texts = blocks.select("key_a", "key_b", "body", words_of(F.col("body")).alias("words")).join(candidates, ["key_a", "key_b"])
    lines = texts.select(
        "key_a", "key_b", "words", "templates",
        F.transform(F.split("body", "\n"), lambda line: words_of(line)).alias("lines"),
    )
    places, hits = [], []
    for t, (label, words, share, phrase) in enumerate(sets):
        candidate = F.array_contains("templates", t)
        if phrase:
            starts = F.when(candidate, _places(F.col("words"), words))
            places.append(F.struct(F.lit(label).alias("label"), F.coalesce(starts, F.array().cast("array<int>")).alias("starts")))
        else:
            most = _best_line(F.col("lines"), sorted(set(words)))
            if across_lines:
                window = _best_window(F.col("words"), sorted(set(words)), ceil(len(words) / contained - 1e-9))
                most = F.greatest(most, window)
            hits.append(F.struct(F.lit(label).alias("label"), F.when(candidate, most).alias("contained")))
    none = "array<struct<label:string,contained:double>>"
    bases = F.array(*places) if places else F.array().cast("array<struct<label:string,starts:array<int>>>")
    found = lines.select(
        "key_a", "key_b",
        F.filter(bases, lambda p: F.size(p["starts"]) > 0).alias("bases"),
        F.filter(F.array(*hits) if hits else F.array().cast(none), lambda h: h["contained"] >= contained).alias("matches"),
    )
    starts = F.flatten(F.transform("bases", lambda p: p["starts"]))
    base_labels = F.transform("bases", lambda p: p["label"])
    labels = F.concat(base_labels, F.transform("matches", lambda h: h["label"]))
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    best = F.when(F.size("bases") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform("matches", lambda h: h["contained"])), F.lit(0.0))
    )
    found = found.select(
        "key_a", "key_b", "matches",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(labels).alias("labels"), best.alias("score"),
    )
    whole = rows.select("key_a", "key_b", "doc_id", "n_words").join(found, ["key_a", "key_b"], "left")
    return whole.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("matches", F.array().cast(none)).alias("matches"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
