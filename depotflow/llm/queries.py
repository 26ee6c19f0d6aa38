"""Queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Url rules, in the order given.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

URL_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
                        ELSE regexp_extract(url[position('://' IN url) + 3:], '^[^/?#]*') END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
              ELSE regexp_extract(url[position('://' IN url) + 3:], '^[^/?#]*([^?#]*)', 1) END AS path
  FROM pages),
marks AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
seen AS (
  SELECT p.host, count(m.good)::BIGINT AS n, coalesce(sum(m.good), 0)::BIGINT AS good
  FROM parts p LEFT JOIN marks m ON m.doc_id = try_cast(nullif(regexp_extract(p.path, '([0-9]+)', 1), '') AS BIGINT)
  GROUP BY p.host),
hosts AS (
  SELECT host, n, good, list_aggregate(string_split(host, '.')[-2:], 'string_agg', '.') AS two,
         list_aggregate(string_split(host, '.')[-3:], 'string_agg', '.') AS three, string_split(host, '.')[-1] AS one
  FROM seen),
named AS (
  SELECT host, n, good,
         CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in') THEN three ELSE two END AS domain,
         CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in') THEN two ELSE one END AS suffix
  FROM hosts),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(good)::BIGINT AS good FROM named GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n)::BIGINT AS n, sum(good)::BIGINT AS good FROM domains GROUP BY suffix),
levels AS (
  SELECT 0 AS level, sum(n)::BIGINT AS n, sum(good)::BIGINT AS good FROM suffixes UNION ALL
  SELECT 1, n, good FROM suffixes UNION ALL SELECT 2, n, good FROM domains UNION ALL SELECT 3, n, good FROM named),
moments AS (
  SELECT level, count(*) AS k, sum(n)::DOUBLE AS n, sum(good::DOUBLE / n * good) AS squares,
         sum(good * (1 - good::DOUBLE / n)) AS binomial
  FROM levels WHERE n > 0 GROUP BY level),
excesses AS (
  SELECT o.level, o.k > a.k AS several, a.binomial / a.n AS binomial,
         (o.squares - a.squares) / a.n - a.binomial / a.n * (o.k - a.k) / a.n AS excess
  FROM moments o JOIN moments a ON a.level = o.level - 1),
strengths AS (
  SELECT l.level, CASE WHEN e.several AND e.excess > 0
                       THEN least(greatest(e.binomial / e.excess - 1, 1.0::DOUBLE), 1000.0::DOUBLE)
                       ELSE 1000.0::DOUBLE END AS s
  FROM (VALUES (1), (2), (3)) AS l(level) LEFT JOIN excesses e ON e.level = l.level),
strength AS (SELECT max(s) FILTER (level = 1) AS s1, max(s) FILTER (level = 2) AS s2, max(s) FILTER (level = 3) AS s3 FROM strengths),
rate AS (SELECT (coalesce(sum(good), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS r FROM suffixes),
suffix_rates AS (SELECT suffix, (good + r * s1) / (n + s1) AS r1 FROM suffixes, rate, strength),
domain_rates AS (SELECT d.domain, (d.good + r1 * s2) / (d.n + s2) AS r2 FROM domains d JOIN suffix_rates USING (suffix), strength),
host_rates AS (SELECT h.host, h.n, s3, (h.good + r2 * s3) / (h.n + s3) AS r3 FROM named h JOIN domain_rates USING (domain), strength),
bounds AS (SELECT host, r3 - 1.645 * sqrt(r3 * (1 - r3) / (n + s3 + 1)) AS bound FROM host_rates),
rules(rule, verdict, host, path) AS (
  VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
         ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'),
         ('net/fr/', 'block', 'net', '/fr/')),
pairs AS (SELECT DISTINCT host, path FROM parts),
fitting AS (
  SELECT p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM pairs p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.verdict, CASE WHEN b.bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM parts p JOIN bounds b ON b.host = p.host LEFT JOIN fitting f ON f.host = p.host AND f.path = p.path
"""


@query("op1_url_reputation", URL_SQL)
def url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose id is the number in its path; that document's quality is its outcome."""
    from depotflow.llm.url_reputation import judge, path_of

    pages = table(spark, sf_dir, "pages")
    marks = table(spark, sf_dir, "labels").where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("good"))
    shown = F.regexp_extract(path_of(F.col("url")), "([0-9]+)", 1)
    shows = pages.select("url", shown.try_cast("bigint").alias("doc_id"))
    return judge(pages, shows.join(marks, "doc_id"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


LICENSE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents),
w AS (SELECT doc_id, row_id, body, regexp_extract_all(body, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d),
p(label, phrase) AS (
  VALUES ('mit', ['mit', 'license']), ('apache', ['apache', 'license']), ('gpl', ['general', 'public', 'license'])),
places AS (
  SELECT row_id, label, unnest(list_filter(range(len(words) - len(phrase) + 1), lambda i: words[i + 1:i + len(phrase)] = phrase)) AS start
  FROM w, p),
base AS (
  SELECT row_id, count(*)::BIGINT AS n_base, min(start)::BIGINT AS first_word, max(start)::BIGINT AS last_word,
         list(DISTINCT label) AS names
  FROM places GROUP BY row_id),
t(label, span, need) AS (
  VALUES ('notice-mit', 7, ['released', 'under', 'the', 'mit', 'license']),
         ('notice-apache', 10, ['licensed', 'under', 'the', 'apache', 'license', 'version', '2', '0']),
         ('notice-gpl', 15, ['this', 'work', 'is', 'licensed', 'under', 'the', 'gnu', 'general', 'public', 'license', 'version', '3']),
         ('notice-cc', 9, ['licensed', 'under', 'cc', 'by', 'nc', '4', '0']),
         ('text-mit', 20, ['permission', 'is', 'hereby', 'granted', 'free', 'of', 'charge', 'to', 'any', 'person', 'obtaining', 'a',
                       'copy', 'this', 'software']),
         ('text-bsd', 18, ['redistribution', 'and', 'use', 'in', 'source', 'binary', 'forms', 'with', 'or', 'without',
                       'modification', 'are', 'permitted']),
         ('text-gpl', 22, ['this', 'program', 'is', 'free', 'software', 'you', 'can', 'redistribute', 'it', 'and', 'or', 'modify',
                       'under', 'the', 'terms', 'of']),
         ('reserved', 4, ['all', 'rights', 'reserved'])),
lines AS (
  SELECT DISTINCT row_id, line FROM (SELECT row_id, unnest(string_split(body, chr(10))) AS line FROM d)),
sets AS (SELECT row_id, list_distinct(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS have FROM lines),
near AS (
  SELECT w.row_id, w.words, t.* FROM w, t
  WHERE len(list_intersect(list_distinct(w.words), need)) >= ceil(0.8 * len(need))),
starts AS (SELECT row_id, words, label, need, span, unnest(range(len(words))) AS i FROM near),
blocks AS (
  SELECT row_id, label, need, have FROM sets, t UNION ALL
  SELECT row_id, label, need, list_distinct(words[i + 1:i + span]) FROM starts),
shares AS (
  SELECT row_id, label, len(list_intersect(have, need))::DOUBLE / len(need) AS share FROM blocks
  WHERE len(list_intersect(have, need)) >= ceil(0.8 * len(need))),
hits AS (SELECT row_id, list(DISTINCT label) AS names, max(share) AS best FROM shares GROUP BY row_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(base.n_base, 0)::BIGINT AS n_base, base.first_word, base.last_word,
       coalesce(array_to_string(list_sort(base.names), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_concat(base.names, hits.names)), ','), '') AS labels,
       CASE WHEN base.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(hits.best, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN base ON base.row_id = w.row_id LEFT JOIN hits ON hits.row_id = w.row_id
"""


@query("op2_license_scan", LICENSE_SQL)
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.license_scan import scan

    return scan(table(spark, sf_dir, "documents"), across_lines=True).drop("matches")


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
item_starts AS (SELECT item_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM sized),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1:s + n], ' ') AS win FROM item_starts),
doc_starts AS (
  SELECT row_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n),
doc_windows AS (SELECT row_id, n, s, array_to_string(w[s + 1:s + n], ' ') AS win FROM doc_starts),
hits AS (SELECT DISTINCT o.row_id, o.n, o.s, i.item_id FROM doc_windows o JOIN item_windows i ON i.n = o.n AND i.win = o.win),
words AS (
  SELECT row_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT row_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY row_id),
items AS (
  SELECT row_id, count(DISTINCT item_id)::BIGINT AS n_items,
         array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids
  FROM hits GROUP BY row_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n_hit, 0)::BIGINT AS n_hit, coalesce(items.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AND 20 * coalesce(words.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words ON words.row_id = d.row_id LEFT JOIN items ON items.row_id = d.row_id
"""


@query("op3_decontamination", CONTAMINATION_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.decontamination import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


@query("op4_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents go to flat files of ids first; the counts come from scanning the files alone."""
    import uuid

    import public_tokenizers

    from depotflow.llm.tables import shared_folder, stored
    from depotflow.llm.token_files import count_tokens, tiktoken_encoder, token_files, write_token_files

    end = 50256  # free in the vocabulary of ranks
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    encode = tiktoken_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    written = stored(write_token_files(table(spark, sf_dir, "documents"), folder, encode, end), "token-plan")
    counted = count_tokens(token_files(spark, folder), end)
    counted = counted.withColumn("file", F.substring_index("path", "/", -1))
    # Both sides grow with the documents, and few blocks unfold into many of them: never broadcast.
    return counted.join(written.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")


@query("op5_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.html_text import extract

    texts = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op6_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.quality import fit, in_fold, labelled_sample, score

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(labelled_sample(docs, labels, "quality", ~in_fold("doc_id", 4, 2)), "quality")
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        in_fold("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op7_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.ngram_jaccard import near_copies

    return near_copies(table(spark, sf_dir, "documents"))


HAMMING_SQL = """
WITH codes AS (SELECT vec_id, list_transform(embedding[1:64], lambda x: x > 0) AS bits FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id,
         len(list_filter(list_zip(q.bits, c.bits), lambda z: z[1] <> z[2]))::BIGINT AS distance
  FROM codes q, codes c WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, neighbour_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM pairs)
WHERE rank <= 10
"""


@query("op8_hamming_search", HAMMING_SQL)
def hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.hamming_search import nearest, sign_codes

    codes = sign_codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 64)
    codes = codes.select(F.col("vec_id").alias("id"), "code")
    found = nearest(codes, codes.where(F.col("id") % 100 == 0), 64, 10)
    return found.withColumns({c: F.col(c).cast("long") for c in ("rank", "distance")})


@query("op9_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.quality import in_fold, labelled_sample
    from depotflow.llm.toxicity import fit_words, score

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = fit_words(docs, labelled_sample(docs, labels, "toxic", ~in_fold("doc_id", 5, 0)), "toxic")
    return score(docs.select("doc_id", "text"), index).select(
        "doc_id",
        in_fold("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("evidence", lambda e: e["doc_id"]).alias("evidence"),
    )


@query("op10_byte_bpe")
def byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.byte_bpe import digests

    return digests(table(spark, sf_dir, "documents"), vocabulary())


@query("op11_va_centroids")
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.centroid_clustering import cluster

    found = cluster(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", k=16, rounds=3, dims=64, factor=64.0)
    digest = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",").cast("binary"), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


LINES_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_id, source, coalesce(text, '') AS body FROM documents),
w AS (SELECT doc_id, row_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words FROM d),
starts AS (SELECT row_id, words, unnest(range(len(words) - 2)) AS i FROM w),
windows AS (SELECT row_id, i, array_to_string(words[i + 1:i + 3], ' ') AS win FROM starts),
again AS (SELECT row_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, win) > 1),
repeats AS (SELECT row_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT row_id, unnest(range(i, i + 3)) AS p FROM again) GROUP BY row_id),
lines AS (SELECT row_id, source, unnest(string_split(body, chr(10))) AS line FROM d),
solid AS (
  SELECT row_id, source, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT row_id, (count(*) - count(DISTINCT line))::BIGINT AS n FROM solid GROUP BY row_id),
frequent AS (SELECT source, norm FROM solid GROUP BY source, norm HAVING count(DISTINCT row_id) > 10),
gone AS (
  SELECT s.row_id, count(*)::BIGINT AS n, sum(s.chars)::BIGINT AS chars
  FROM solid s JOIN frequent f ON f.norm = s.norm AND f.source IS NOT DISTINCT FROM s.source GROUP BY s.row_id),
counted AS (
  SELECT w.doc_id, len(w.words)::BIGINT AS n_words,
         length(regexp_replace(w.body, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(w.body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.n, 0)::BIGINT AS n_removed_lines, coalesce(gone.chars, 0)::BIGINT AS removed
  FROM w LEFT JOIN dups ON dups.row_id = w.row_id LEFT JOIN repeats ON repeats.row_id = w.row_id
  LEFT JOIN gone ON gone.row_id = w.row_id),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (word_chars - removed) >= 50 * word_chars AS kept, n_removed_lines, word_chars - removed AS left_chars
FROM judged
"""


@query("op12_line_frequency", LINES_SQL)
def line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.line_frequency import line_rules

    judged = line_rules(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~F.col("depleted")).alias("kept"), "n_removed_lines", "left_chars",
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by the crc32 of its id goes on periodically from some word."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    g, n = F.expr("h div 10"), F.size("words")
    placed = chosen.select("doc_id", "text", "words", n.alias("n"), g.alias("g"), F.when(n > 0, F.pmod(g, n)).cast("int").alias("a"))
    placed = placed.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.expr("cast((n - a + p - 1) div p as int)")
    tail = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), F.col("n") - F.col("a"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depotflow.llm.periodic_runs import periodic_runs as find

    found = find(with_periods(table(spark, sf_dir, "documents")), "text", least=6)

    def better(best, run):
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    top = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.array_join(lines, "").alias("listed"), "collapsed")
    return found.select(
        "doc_id",
        "n_runs",
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
