import pytest

from depotflow.llm.decontamination import contamination, gram_and_run
from tests.llm import data

DOCS, ITEMS = "doc_id long, text string, prints string, item_id long", "item_id long, text string, lang string"


def brute(docs, items):
    windows: dict[tuple, set] = {}
    lengths = set()
    for item_id, text in items:
        w = data.words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item_id)
            lengths.add(n)
    out = []
    for doc_id, text in docs:
        w = data.words(text)
        hit, ids = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids |= found
        ids = sorted((i for i in ids if i is not None), key=str)
        out.append((doc_id, len(w), len(hit), len(ids), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, None) for i, t in items], ITEMS)
    return [tuple(r) for r in contamination(d, b).collect()]


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_lengths_keep_the_guarantee():
    assert all(sum(gram_and_run(n)) == n + 1 for n in range(1, 14))


def test_against_brute_force(spark):
    base = data.prose(1, 400, 400)
    items = [(10, " ".join(base[:40])), (9, " ".join(base[100:115]).upper()), (2, " ".join(base[200:203])), (3, base[300]),
             (4, None), (5, ""), (6, "... !"), (10, " ".join(base[150:170])), (None, " ".join(base[220:240])),
             (11, " ".join(base[:40])), (12, "a a a a a a a a a a a a a a a a")]
    other = data.prose(2, 300, 500)
    docs = [(1, " ".join(other[:100] + base[5:18] + other[100:200])), (2, " ".join(other[:50] + base[5:17] + other[50:90])),
            (3, "-".join(base[100:115])), (4, " ".join(other[:9] + base[200:203])), (5, base[300]), (6, None), (7, ""),
            (8, " ".join(other[:200] + base[225:240])), (8, " ".join(other[:200] + base[225:240])), (None, " ".join(base)),
            (9, " ".join(base[:40] + other[:3000] + base[150:170])), (11, "a " * 60), (12, "a " * 12)]
    same(run(spark, docs, items), brute(docs, items))


def test_shared_passage_in_every_item_and_document(spark):
    passage = data.prose(5, 20, 300)
    items = [(i, " ".join(data.prose(100 + i, 6, 300) + passage)) for i in range(30)]
    docs = [(i, " ".join(passage + data.prose(500 + i, 30, 300))) for i in range(40)]
    same(run(spark, docs, items), brute(docs, items))


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b"), (2, None)], []), ([(1, "a b")], [(1, None), (2, " ")])])
def test_empty_tables(spark, docs, items):
    same(run(spark, docs, items), brute(docs, items))


def test_row_keys_only_where_asked_for(spark):
    d = spark.createDataFrame([(1, "a b", "x", 7)], DOCS)
    for items in ([(1, "a b", None)], []):
        b = spark.createDataFrame(items, ITEMS)
        plain = ["doc_id", "n_words", "n_hit", "n_items", "item_ids", "contaminated"]
        assert contamination(d, b).columns == plain
        assert contamination(d, b, keyed=True).columns == [*plain, "key_a", "key_b"]
