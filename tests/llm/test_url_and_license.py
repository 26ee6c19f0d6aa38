import pytest
from pyspark.sql import functions as F

from depotflow.llm.license_scan import scan
from depotflow.llm.queries import ORACLE_SQL, QUERIES, URL_RULES
from depotflow.llm.url_reputation import domain_of, judge, suffix_of
from tests.llm import data
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql_twin(spark, name):
    assert difference(spark, connect(FOLDER), name, QUERIES[name], ORACLE_SQL[name], FOLDER) is None


def urls(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, host string")


def test_hosts_paths_and_rules(spark):
    rows = [
        (1, "http://WWW.Example.COM/en/1?x=/net", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (2, "https://shop.example.com/en/", "shop.example.com", "/en/", "example.com/en/", "block"),
        (3, "https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
        (4, "ftp://com", "com", "", None, "block"),
        (5, "a://b.net/fr/://c#d", "b.net", "/fr/://c", "net/fr/", "block"),
        (6, "x://y.net#/es/", "y.net", "", None, "block"),
        (7, "no scheme", "", "", None, "block"),
        (8, None, "", "", None, "block"),
        (9, "", "", "", None, "block"),
        (9, "", "", "", None, "block"),
        (None, "s:///p", "", "/p", None, "block"),
    ]
    bad = urls(spark, [(0, "u://bad.net/1", None)] * 50).select("url", F.lit(0).alias("good"))
    got = judge(urls(spark, [(i, u, "clash") for i, u, *_ in rows]), bad, URL_RULES).collect()
    want = [(i, h, p, r, v) for i, _, h, p, r, v in rows]
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))


def test_reputation_shrinks_towards_the_domain(spark):
    good = [(f"u://h{i}.fine.org/", int(j > 0)) for i in range(20) for j in range(10)] + [("u://c.fine.org/", 0)]
    bad = [(f"u://h{i}.poor.org/", int(j == 0)) for i in range(20) for j in range(10)] + [("u://c.poor.org/", 1)]
    bad += [("u://x.org/", 5), (None, 1)]
    outcomes = spark.createDataFrame(good + bad, "url string, good int")
    pages = urls(spark, [(i, f"u://{h}/", None) for i, h in enumerate(["c.fine.org", "c.poor.org", "new.fine.org", "new.poor.org"])])
    verdicts = {r["host"]: (r["verdict"], r["bound"]) for r in judge(pages, outcomes, []).collect()}
    assert verdicts["new.fine.org"][1] > verdicts["c.fine.org"][1] > verdicts["c.poor.org"][1] > verdicts["new.poor.org"][1]
    assert verdicts["new.fine.org"][0] == "allow" and verdicts["new.poor.org"][0] == "block"


def test_domains(spark):
    hosts = spark.createDataFrame([(h,) for h in ("a.b.example.co.uk", "a.example.com", "example.com", "com", "")], "h string")
    got = [tuple(r) for r in hosts.select(domain_of(F.col("h")), suffix_of(F.col("h"))).collect()]
    assert got == [("example.co.uk", "co.uk"), ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("", "")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "url string, good int")
    assert judge(urls(spark, []), none, URL_RULES).count() == 0
    assert judge(urls(spark, [(1, "u://a.org/", None)]), none, URL_RULES).count() == 1
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


PHRASES = {"mit license": "mit", "a b a": "aba"}
TEMPLATES = {"five": "alpha beta gamma delta epsilon", "same": "beta beta beta"}


def plain(text):
    w = data.words(text)
    starts, base = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    best, labels = 0.0, set(base)
    for label, template in TEMPLATES.items():
        own = set(template.split())
        share = max(len(own & set(data.words(line))) / len(own) for line in (text or "").split("\n"))
        if share >= 0.8:
            labels.add(label)
            best = max(best, share)
    edge = (min(starts), max(starts)) if starts else (None, None)
    return (len(w), len(starts), *edge, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best)


def test_scan_against_plain_rules(spark):
    texts = [
        None, "", "MIT license", "mit\nLicense mit, license", "a b a b a", "epsilon delta x gamma BETA", "alpha beta gamma\ndelta epsilon",
        "beta", "alpha beta gamma delta epsilon mit license " * 2000, "é mit-license é", "mit mit license license", "x " * 300,
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + texts[2:4])] + [(None, "mit license", "x")], "doc_id long, text string, words string")
    got = scan(docs, PHRASES, TEMPLATES).drop("matches").collect()
    want = [(i, *plain(t)) for i, t in enumerate(texts + texts[2:4])] + [(None, *plain("mit license"))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_no_python_on_the_main_path(spark):
    for name in ("op1_url_reputation", "op2_license_scan"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_wrapped_notices_across_lines(spark):
    bsd = " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that"
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License"
    apart = "alpha beta\n" + "x " * 9 + "\ngamma delta epsilon"
    texts = [bsd, gpl, "alpha beta gamma\ndelta epsilon", apart, "alpha beta", apart.replace("\n", " "), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in scan(docs, across_lines=True).collect()}
    assert found[0]["labels"] == "text-bsd" and found[0]["score"] == 1.0 and found[1]["labels"] == "gpl,text-gpl"
    five = {"five": "alpha beta gamma delta epsilon"}
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in scan(docs, PHRASES, five, across_lines=True).collect()}

    def best(text):
        own, w = set(five["five"].split()), data.words(text)
        blocks = [set(data.words(line)) for line in (text or "").split("\n")] + [set(w[i : i + 7]) for i in range(len(w))]
        return max(len(own & b) for b in blocks) / 5

    assert got == {i: ("five", best(t)) if best(t) >= 0.8 else ("", 0.0) for i, t in enumerate(texts)} and got[2] == ("five", 1.0)
