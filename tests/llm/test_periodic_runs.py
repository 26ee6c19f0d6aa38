import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from depotflow.llm.periodic_runs import periodic_runs, runs
from depotflow.llm.queries import QUERIES, with_periods
from tests.llm import data


def brute(words, least=6, times=4):
    """Every maximal stretch whose words agree with those a period further, smallest periods first."""
    n, out, known = len(words), [], set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q) and (i, length) not in known:
                known.add((i, length))
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def rewritten(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = rewritten(doc_id, data.NOT_SPACE.findall(text or ""))
    found = brute(words)
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = 1000 * top[1] // top[2] if found else None
    return (doc_id, len(found), *top, milli, digest(listed), digest(collapsed(words, found)))


def mixed(rnd):
    words = [rnd.randrange(rnd.choice([1, 2, 3, 5, 40])) for _ in range(rnd.choice([0, 3, 20, 90, 300]))]
    for _ in range(rnd.randint(0, 4) if len(words) > 4 else 0):
        a = rnd.randrange(len(words))
        p = rnd.randint(1, max(1, (len(words) - a) // 4))
        for i in range(a, rnd.randint(a, len(words))):
            words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_brute_force_on_nested_periods():
    rnd = random.Random(5)
    for _ in range(400):
        rows = [mixed(rnd) for _ in range(rnd.randint(1, 4))]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        found = zip(*[x.tolist() for x in runs(np.array([w for r in rows for w in r], dtype=np.int64), bounds)])
        assert list(found) == [(i, *r) for i, row in enumerate(rows) for r in brute(row, least=1)]


def test_rows_and_awkward_texts(spark):
    rnd = random.Random(2)
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "A a A a A a A a", " ".join(["x y z"] * 5), "é ß é ß é ß é ß"]
    texts += ["  ".join("abab" * 9)] + [" ".join(f"w{x}" for x in mixed(rnd)) for _ in range(40)]
    long = data.prose(4, 30_011, 10**6)
    texts += [" ".join(long * 4 + long[:77]), texts[7], texts[7]]
    rows = [(i if i % 7 else None, t, [i], "here") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs array<int>, collapsed string")
    out = periodic_runs(df).collect()
    assert [f for f in periodic_runs(df).columns] == ["doc_id", "text", "n_words", "runs", "collapsed"]
    assert len(out) == len(rows)
    for r in out:
        words = data.NOT_SPACE.findall(r["text"] or "")
        found = brute(words) if len(words) < 10_000 else [(0, len(words), 30_011)]
        assert [tuple(x) for x in r["runs"]] == found
        assert (r["n_words"], r["collapsed"]) == (len(words), collapsed(words, found))
    assert periodic_runs(df.where("false")).collect() == []
    five = periodic_runs(df.select("text"), times=5).collect()
    assert all(x["length"] >= 5 * x["period"] for r in five for x in r["runs"])


def test_planted_periods(spark):
    rows = [(i, " ".join(data.prose(i, i % 60, 30))) for i in range(300)] + [(None, "a b"), (10**12, None)]
    out = with_periods(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r, (doc_id, text) in zip(sorted(out, key=lambda r: (r["doc_id"] is None, r["doc_id"])), sorted(rows, key=lambda r: (r[0] is None, r[0]))):
        words = data.NOT_SPACE.findall(text or "")
        assert data.NOT_SPACE.findall(r["text"] or "") == (words if doc_id is None else rewritten(doc_id, words))


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(i, " ".join(data.prose(i, 3 * (i % 50), 40)) if i % 9 else None) for i in range(400)]
    rows += [(1001, "to be or " * 9), (1002, "a"), (1003, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect())
    assert got == sorted(expected(*r) for r in rows)
