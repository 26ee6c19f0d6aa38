import random
from collections import Counter, defaultdict

import pytest

from depotflow.llm import line_frequency
from depotflow.llm.line_frequency import line_rules
from depotflow.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import data
from tests.oracle import connect, difference

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "left_chars", "depleted"]


def brute(rows, most, least):
    words = data.NOT_SPACE.findall
    lines = [[x for x in (t or "").split("\n") if words(x)] for _, _, t in rows]
    norm = lambda x: " ".join(words(x.translate(data.LOWER)))
    holders = defaultdict(set)
    for i, (_, host, _) in enumerate(rows):
        for x in lines[i]:
            holders[host, norm(x)].add(i)
    out = []
    for i, (doc_id, host, text) in enumerate(rows):
        w = words(text or "")
        windows = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        times = Counter(windows)
        repeats = {j + k for j, x in enumerate(windows) if times[x] > 1 for k in range(3)}
        gone = [x for x in lines[i] if len(holders[host, norm(x)]) > most]
        chars = sum(map(len, w))
        left = chars - sum(len("".join(words(x))) for x in gone)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        out.append((doc_id, len(w), chars, symbols, len(lines[i]) - len(set(lines[i])), len(repeats), len(gone), left, 100 * left < least * chars))
    return out


def cases():
    rnd = random.Random(6)
    menu = ["Home | About | Contact", "home |  ABOUT | contact ", "© é ß", "#1 *2* $3"]
    rows = [(1, "a", None), (2, "a", ""), (3, None, " \n\t\n"), (4, None, "x"), (5, "", "x"), (None, "a", "x y z x y z"), (6, "a", "x x x x x")]
    for i in range(120):
        own = [" ".join(data.prose(i * 50 + j, rnd.randint(0, 9), 30)) for j in range(rnd.randint(0, 6))]
        shared = [rnd.choice(menu) for _ in range(rnd.randint(0, 3))]
        rows.append((i + 10, rnd.choice(["a", "a", "b", None]), "\n".join(own + shared + own[:1])))
    rows += [rows[30], rows[30], (7, "a", "word " * 30_000)]
    return rows


def shown(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=key)


@pytest.mark.parametrize("hot", [10_000, 3])
def test_equals_brute_force(spark, hot):
    rows = cases()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, lines string")
    got = shown(line_rules(df, most_documents=5, least_left=60, hot_lines=hot))
    key = lambda r: tuple((x is None, x) for x in r)
    assert got == sorted(brute(rows, 5, 60), key=key)
    assert any(r[-1] for r in got) and any(r[6] and not r[-1] for r in got)
    assert shown(line_rules(df.where("false"))) == []


def test_few_lines_are_broadcast(spark):
    """Only lines with a large part of all entries are broadcast, whatever the number of frequent ones."""
    counts = spark.range(1000).selectExpr("id row", "array(struct(id % 50 key, 1 chars), struct(-1L key, 2 chars)) lines")
    frequent = line_frequency.frequent_lines(counts, 10)
    assert frequent.count() == 51
    out = line_frequency.removed_lines(counts, frequent, 2000, hot=4)
    assert out.where("n_removed_lines = 2 and removed_chars = 3").count() == 1000


def test_query_has_no_python_on_its_way(spark):
    plan = QUERIES["op12_line_frequency"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_its_twin(spark):
    sf = "/root/testdata/sf0.01"
    name = "op12_line_frequency"
    assert difference(spark, connect(sf), name, QUERIES[name], ORACLE_SQL[name], sf) is None
