import random

import pytest

from depotflow.llm import ngram_jaccard
from depotflow.llm.components import components
from depotflow.llm.ngram_jaccard import boundary, first_shingles, least_overlap, most_frequent, near_copies
from depotflow.llm.tables import Scratch
from tests.llm import data


def shingles(text):
    w = data.words(text, data.NOT_SPACE)
    if not w:
        return set()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)}


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, other = sets[a][1], sets[b][1]
            if one and 100 * len(one & other) >= 85 * len(one | other):
                parent[top(a)] = top(b)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(sets):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted((doc_id, len(s), least[top(i)]) for i, (doc_id, s) in enumerate(sets))


def run(spark, docs):
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, class string")
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_copies(df).collect())


def edited(words, seed, edits):
    rnd, out = random.Random(seed), list(words)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"new{rnd.randrange(10**6)}"
    return " ".join(out)


def cases():
    docs = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b c"), (7, "a  b\tc"), (8, "a b c d"), (9, "a b c d")]
    n = 10
    for size in (5, 8, 10, 12, 16, 23, 30, 60, 120):
        base = data.prose(size, size, 10**4)
        for k in range(6):
            docs.append((n, edited(base, n, k)))
            docs.append((n + 1, " ".join(base[k:])))
            n += 2
    passage = data.prose(3, 50, 10**4)
    for k in range(12):
        docs.append((n, " ".join(passage + data.prose(900 + k, 12 + 4 * k, 10**4))))
        n += 1
    random.Random(4).shuffle(docs)
    return docs


@pytest.mark.parametrize("largest", [None, 0, 12, 24])
def test_against_brute_force_with_any_boundary(spark, monkeypatch, largest):
    if largest is not None:
        monkeypatch.setattr(ngram_jaccard, "boundary", lambda sizes, scan: largest)
    docs = cases()
    assert run(spark, docs) == brute(docs)


def test_few_frequent_shingles_and_hub_rounds(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "FREQUENT", 50)
    monkeypatch.setattr(ngram_jaccard, "FEW", 0.01)
    base = data.prose(8, 80, 10**4)
    docs = [(1000 - i, edited(base, i, 1 + i % 4)) for i in range(60)] + cases()[:40]
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    assert run(spark, docs) == brute(docs)


def test_repeated_rows_and_empty_table(spark):
    docs = [(5, "x y z u v"), (5, "x y z u v"), (3, "x y z u v"), (7, "q w e r t")]
    assert run(spark, docs) == [(3, 2, 3), (5, 2, 3), (5, 2, 3), (7, 2, 7)]
    assert run(spark, []) == []


def test_null_ids_take_part(spark):
    df = spark.createDataFrame([(None, "x y z u v"), (2, "x y z u v"), (None, "lone text here ok")], "doc_id long, text string")
    assert sorted(map(str, ((r["doc_id"], r["component_id"]) for r in near_copies(df).collect()))) == ["(2, 2)", "(None, 2)", "(None, None)"]


def test_bounds():
    for n in range(1, 80):
        for m in range(n, 80):
            need = least_overlap(n, m)
            assert 100 * need >= 85 * (n + m - need) and 100 * (need - 1) < 85 * (n + m - need + 1)
        assert first_shingles(n) == n - -(-85 * n // 100) + 1
    assert boundary({}, 1.0) == 0 and boundary({6: 10}, 50.0) >= 6


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(5, 5)]
    links += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(60)]
    parent = {x: x for link in links for x in link}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark), "test").collect()
    real = {x for a, b in links if a != b for x in (a, b)}
    assert {(r["node"], r["component"]) for r in found} == {(x, top(x)) for x in real} and len(found) == len(real)


@pytest.mark.parametrize("gram, percent", [(4, 85), (5, 80)])
def test_every_link_is_counted(spark, gram, percent):
    def own(text):
        w = data.words(text, data.NOT_SPACE)
        return frozenset(tuple(w[i : i + gram]) for i in range(len(w) - gram + 1)) or frozenset([tuple(w)] if w else [])

    base = data.prose(8, 80, 10**4)
    docs = [(1000 + i, edited(base, i, 1 + i % 2)) for i in range(40)] + [(2000, edited(base, 0, 1))] + cases()[:30]
    sets = {i: own(t) for i, t in docs}
    links = lambda a, b: a != b and bool(a) and 100 * len(a & b) >= percent * len(a | b)
    want = sorted((i, len(s), sum(links(s, o) for o in set(sets.values()))) for i, s in sets.items())
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = near_copies(df, gram, percent, count_links=True).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got) == want
    assert all(r["linked"] == (r["n_links"] > 0) for r in got) and max(n for _, _, n in want) > 5


@pytest.mark.parametrize("most", [0, 1, 7, 40, 1000])
def test_most_frequent_fill_their_room(spark, most):
    rng = random.Random(most)
    prints = rng.sample(range(1 << 44), 300)
    counts = [1 << 20] * 100 + [70_000] * 50 + [rng.randint(2, 9) for _ in range(150)]
    table = spark.createDataFrame(list(zip(prints, counts)), "print long, n long")
    got = dict(zip(*(x.tolist() for x in most_frequent(table, most))))
    known = dict(zip(prints, counts))
    assert all(known[p] == n for p, n in got.items()) and list(got) == sorted(got)
    # Blocks of prints hold one each or two here, so nearly all of the room is used.
    assert min(most, 300) - 2 <= len(got) <= most
    rest = [n for p, n in known.items() if p not in got]
    assert not got or not rest or min(got.values()) >= max(rest)


def test_copies_of_one_text_make_few_pairs(spark, monkeypatch):
    # Every copy links with the text, few with each other: pairs may not grow with the square of the group.
    base = data.prose(8, 150, 10**4)
    docs = [(0, " ".join(base)), *((i, edited(base, i, 1 + i % 5)) for i in range(1, 241))]
    rows, put = {}, Scratch.put

    def counted(self, df, what):
        table = put(self, df, what)
        if what.startswith("pairs"):
            rows[what] = table.count()
        return table

    monkeypatch.setattr(Scratch, "put", counted)
    assert run(spark, docs) == brute(docs)
    assert 0 < sum(rows.values()) < 4 * len(docs)


@pytest.mark.parametrize("n_rare", [0, 1])
def test_entries_need_another_of_like_size(spark, n_rare):
    sizes = {1: (100, 117, 118, 200, 240, 283), 2: (50,), 3: (85, 100), 4: (84, 100)}
    rows = [(10 * key + i, n, ([key], [0], n_rare)) for key, ns in sizes.items() for i, n in enumerate(ns)]
    listed = spark.createDataFrame(rows, "class long, n int, index struct<keys array<long>, places array<int>, n_rare int>")
    got = {(r["key"], r["n"]) for r in ngram_jaccard.shared_entries(listed).collect()}
    need = {(k, n) for k, ns in sizes.items() for n in ns if any(100 * min(n, m) >= 85 * max(n, m) for m in ns if m != n)}
    assert need <= got <= {(k, n) for k, ns in sizes.items() for n in ns}
    assert (2, 50) not in got and (got == need or not n_rare)


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_texts_of_marked_rows(spark, monkeypatch, most):
    monkeypatch.setattr(ngram_jaccard, "MOST_WORDS", most)
    texts = spark.createDataFrame([(i * 7919, -i, f"t{i}") for i in [*range(200), 5, 5]], "key_a long, key_b long, text string")
    rows = spark.createDataFrame([(i, i * 7919, -i) for i in range(0, 200, 5)], "class long, key_a long, key_b long")
    got = sorted((r["class"], r["text"]) for r in ngram_jaccard.texts_of(rows, texts).collect())
    assert got == [(i, f"t{i}") for i in range(0, 200, 5)]


def test_a_hub_leaves_its_list(spark, monkeypatch):
    # Two sets of each pair, and the first four, share many lists and do not link: once compared, they are done.
    monkeypatch.setattr(ngram_jaccard, "FEW", 0)
    base = data.prose(700, 200, 10**4)
    docs = [(100 + i, " ".join(base[:170] + data.prose(6000 + i, 30, 10**4))) for i in range(4)]
    docs += [(200 + i, edited(base, i, 1)) for i in range(4)]
    for k in range(30):
        base = data.prose(500 + k, 200, 10**4)
        docs += [(2 * k, " ".join(base[:175] + data.prose(5000 + k, 25, 10**4))), (2 * k + 1, " ".join(base))]
    lists, put = [], Scratch.put

    def counted(self, df, what):
        table = put(self, df, what)
        if what.startswith("across"):
            lists.append(table.count())
        return table

    monkeypatch.setattr(Scratch, "put", counted)
    assert run(spark, docs) == brute(docs)
    assert lists[0] > 150 and lists[1:] == [0]
