import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depotflow.llm import quality, toxicity
from depotflow.llm.wordhash import slices, words, ALNUM
from tests.llm import data

FOLDER = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_held_out_quality(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    model = quality.fit(quality.labelled_sample(docs, labels, "quality", ~quality.in_fold("doc_id", 4, 2)), "quality")
    held = quality.score(docs, model).where(quality.in_fold("doc_id", 4, 2)).join(labels, "doc_id").toPandas()
    assert ((held["score"] >= 0.7) == (held["quality"] == 1)).mean() > 0.95
    assert held["score"].between(0, 1).all()


def test_density_ratio_against_plain_formula():
    rng = np.random.default_rng(1)
    x = [rng.normal(c, 1 + c, (500, quality.SIZE)) @ rng.normal(0, 1, (quality.SIZE, quality.SIZE)) for c in (0, 1)]
    model = quality.discriminant(np.array([quality._moments(a) for a in x]))
    z = (np.vstack(x) - model.centre) / model.scale
    want = []
    for mean, factor in zip(model.means, model.factors):
        cov = factor @ factor.T
        want.append(-0.5 * (np.einsum("ij,jk,ik->i", z - mean, np.linalg.inv(cov), z - mean) + np.linalg.slogdet(cov)[1]))
    assert np.allclose(model.log_ratio(np.vstack(x)), want[1] - want[0] + model.log_odds)


def test_statistics_do_not_depend_on_slices():
    texts = ["", "A b! C", "LOUD WORDS!!", "x x x x x", "ünï çode", None, "a" * 50, "1 2 | 3 |"] * 3
    whole = np.vstack([quality.statistics(p) for p in slices(pa.array(texts))])
    small = np.vstack([quality.statistics(p) for p in slices(pa.array(texts), 7)])
    assert whole.shape == (24, quality.SIZE) and np.allclose(whole, small) and np.isfinite(whole).all()


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 0, 0), (1, 1, 1), (2, None, None), (None, 1, 1), (3, 7, 7)]])
def test_few_or_odd_labels_nulls_and_repeats(spark, labels):
    rows = [(1, "idiot text here", 0.5), (1, "idiot text here", 0.5), (2, None, None), (3, "", 1.0), (None, "words " * 3000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    known = quality.labelled_sample(docs, marks, "quality", F.lit(True))
    got = quality.score(docs, quality.fit(known, "quality")).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    index = toxicity.fit(docs, quality.labelled_sample(docs, marks, "toxic", F.lit(True)), "toxic")
    got = toxicity.score(docs, index).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs.limit(0), index).count() == 0
    toxicity.fit(docs.limit(0), known.limit(0).withColumnRenamed("quality", "toxic"), "toxic")


def test_the_fold_is_never_learned_from(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    docs = labels.select("doc_id", F.lit("x").alias("text"))
    known = quality.labelled_sample(docs, labels, "quality", ~quality.in_fold("doc_id", 4, 2), most=100)
    ids = [r["doc_id"] for r in known.collect()]
    import zlib

    assert len(ids) == 100 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)


def test_toxic_words_are_learned_with_evidence(spark):
    rnd = random.Random(2)
    plain = [" ".join(data.prose(i, 40, 300)) for i in range(300)]
    rows = [(i, t + (" " + rnd.choice(["scoundrel", "villain"]) + " there" if i % 5 == 0 else "")) for i, t in enumerate(plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(250)], "doc_id long, toxic int")
    index = toxicity.fit(docs, quality.labelled_sample(docs, labels, "toxic", F.lit(True)), "toxic")
    for r in toxicity.score(docs, index).collect():
        assert (r["score"] >= 0.5) == (r["doc_id"] % 5 == 0)
        assert all(e["label"] == 1 for e in r["evidence"]) and bool(r["evidence"]) == (r["doc_id"] % 5 == 0)


def test_neighbours_are_exact():
    rng = np.random.default_rng(3)
    dense = rng.random((700, 40)) * (rng.random((700, 40)) < 0.1)
    dense = dense[dense.any(axis=1)]
    dense[5:60] = dense[4]  # ties
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    order = np.lexsort((-dense.max(axis=1), dense.argmax(axis=1)))
    dense = dense[order]
    ids = rng.permutation(len(dense))
    edges = np.arange(0, len(dense), toxicity.BLOCK)
    index = toxicity.Index(np.arange(40), np.ones(40), dense, ids, ids % 2, np.maximum.reduceat(dense, edges, axis=0), 0.1, 0.1)
    for i in range(0, len(dense), 7):
        at = np.flatnonzero(dense[i])
        places, cosines = index.nearest(at, dense[i][at])
        every = np.round(dense @ dense[i], 9)
        best = [p for p in np.lexsort((ids, -every)) if every[p] > 0][: toxicity.NEIGHBOURS]
        assert ids[places].tolist() == ids[best].tolist() and np.allclose(cosines, every[best])


def test_matches_counts_terms():
    terms = np.sort(words(next(slices(pa.array(["bad worse"]))), ALNUM).hashes)
    row, at, counts = toxicity.matches(next(slices(pa.array(["Bad bad, worse", None, "fine", "WORSE"]))), terms)
    assert sorted(zip(row.tolist(), counts.tolist())) == [(0, 1), (0, 2), (3, 1)]


def test_every_word_and_every_example_takes_part(spark):
    plain = [" ".join(data.prose(i, 40, 300)) for i in range(60)]
    docs = spark.createDataFrame([*enumerate(plain), (60, "quite unmarked here"), (61, ""), (62, "unseen")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(60)] + [(60, 1), (61, 0)], "doc_id long, toxic int")
    index = toxicity.fit_words(docs, quality.labelled_sample(docs, labels, "toxic", F.lit(True)), "toxic")
    own = {i: data.words(t) for i, t in [*enumerate(plain), (60, "quite unmarked here")]}
    assert sorted(index.ids) == list(range(62)) and len(index.terms) == len({w for t in own.values() for w in t})
    found = {r["doc_id"]: r["evidence"] for r in toxicity.score(docs, index).collect()}
    assert not found[61] and not found[62]
    # Plain version of the rule; one toxic document of 62 makes no word sure.
    df = {w: sum(w in set(t) for t in own.values()) for t in own.values() for w in t}
    vectors = {}
    for i, t in own.items():
        v = {w: (1 + np.log(t.count(w))) * (np.log(64 / (df[w] + 1)) + 1) for w in set(t)}
        length = np.sqrt(sum(x * x for x in v.values()))
        vectors[i] = {w: x / length for w, x in v.items()}
    for i, v in vectors.items():
        cosines = {j: sum(x * o.get(w, 0) for w, x in v.items()) for j, o in vectors.items()}
        best = sorted((round(-c, 6), j) for j, c in cosines.items() if c > 0)[: toxicity.NEIGHBOURS]
        assert np.allclose([-c for c, _ in best], [e["cosine"] for e in found[i]], atol=1e-5) and found[i][0]["doc_id"] == i


def test_neighbours_by_postings_are_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    rng = np.random.default_rng(5)
    dense = rng.integers(1, 4, (500, 60)) * (rng.random((500, 60)) < 0.08)
    dense[5:60] = dense[4]  # ties
    dense[7] = 0
    ids, idf = rng.permutation(500), rng.random(60) * 9 + 0.1
    index = toxicity.word_index(np.arange(60), idf, [(np.flatnonzero(x), x[x > 0]) for x in dense], ids, ids % 2, 0.1)
    assert len(index.ids) == 500 and (np.diff(index.edges) <= 16).all()
    unit = np.where(dense > 0, (1 + np.log(np.maximum(dense, 1))) * idf, 0)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)
    for i in [*range(0, 500, 5), 4]:
        at = np.flatnonzero(unit[i])
        places, cosines = index.nearest(at, unit[i][at])
        every = np.round(unit @ unit[i], 9)
        best = [p for p in np.lexsort((ids, -every)) if every[p] > 0][: toxicity.NEIGHBOURS]
        assert index.ids[places].tolist() == ids[best].tolist() and np.allclose(cosines, every[best])
