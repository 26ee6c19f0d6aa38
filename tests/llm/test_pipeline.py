from pathlib import Path

import pyarrow as pa

import corpus_pipeline
from depotflow.llm import quality
from depotflow.llm.queries import QUERIES
from depotflow.llm.tables import shared_folder
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_ngram_jaccard import brute as grouped

FOLDER = "/root/testdata/sf0.001"


def test_stages_drop_what_the_operators_reject(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        assert docs.columns == columns
        after = {r["doc_id"] for r in docs.collect()}
        if "Jaccard" in name:
            assert after == {c for _, _, c in grouped(sorted(before.items()))}
        elif "decontamination" in name:
            assert after == {r[0] for r in contaminated(sorted(before.items()), items) if not r[-1]}
        else:
            label = "quality" if "quality" in name else "toxic"
            marks = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r["doc_id"] in before}
            kept = sum((i in after) == (m == (label == "quality")) for i, m in marks.items())
            assert kept >= 0.9 * len(marks)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(last) == sorted(whole) and {r["doc_id"] for r in last} == after


def test_stage_inputs_may_be_empty_or_null(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, None, None, None)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), FOLDER).count() == 0
        stage(spark, spark.createDataFrame(rows, schema), FOLDER).collect()


def test_rows_with_shared_and_null_ids_are_decided_alone(spark):
    """A row goes by its own text: an id that another row shares, or a null one, does not decide."""
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    passage = next(t for t in items.values() if t and len(t.split()) > 15)
    base = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"else{i}" for i in range(60))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, base), (2, base), (2, other), (3, passage), (3, other + " three"), (None, passage), (None, "alone"), (None, "alone"), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)
    kept = lambda stage: sorted(((r["doc_id"], r["text"]) for r in stage(spark, docs, FOLDER).collect()), key=str)
    one = kept(corpus_pipeline.one_of_each)
    # base of 2 is a copy of 1; the two texts around ``other`` are near copies, so the one of 3 goes; repeats of a row are one.
    assert one == sorted([(1, base), (2, other), (3, passage), (None, passage), (None, "alone"), (4, None), (5, "")], key=str)
    clean = kept(corpus_pipeline.uncontaminated)
    assert clean == sorted([(i, t) for i, t in rows if t != passage], key=str)


def test_a_run_leaves_its_last_input_only(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("_SUCCESS"))
    out = corpus_pipeline.run(spark, FOLDER)
    names = {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES}
    left = [p.parent.name for p in set(folder.rglob("_SUCCESS")) - before if p.parent.name in names]
    assert left == ["benchmark-decontamination"] and out.count() > 0


def test_queries_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and quality.SAMPLE == 20_000


def test_stages_send_small_batches_to_python(spark):
    """Batches are bounded by rows and by bytes, also where the session allows larger ones."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(rows), spark.conf.get(size)

    def measured(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [sum(map(len, batch.column(0).to_pylist()))]})

    many, long = spark.range(2000, numPartitions=1), spark.range(24, numPartitions=1)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(rows, 10000)
            spark.conf.set(size, 1 << 30)
            docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
            stage(spark, docs, FOLDER)
            short = many.selectExpr("'a' as text").mapInArrow(measured, "n long, bytes long").collect()
            assert sum(r["n"] for r in short) == 2000 and max(r["n"] for r in short) <= 500
            wide = long.selectExpr("repeat('a', 1 << 20) as text").mapInArrow(measured, "n long, bytes long").collect()
            assert sum(r["n"] for r in wide) == 24 and max(r["bytes"] for r in wide) <= 8 << 20
        spark.conf.set(rows, 100)
        corpus_pipeline.token_ids(spark, docs, FOLDER)
        assert spark.conf.get(rows) == "100"  # smaller ones stay
    finally:
        spark.conf.set(rows, before[0])
        spark.conf.set(size, before[1])
