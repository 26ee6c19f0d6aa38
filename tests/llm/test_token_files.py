import numpy as np
import pytest

from depotflow.llm.queries import QUERIES
from depotflow.llm.token_files import count_tokens, token_files, write_token_files

END = 9


def lengths(tokens):
    out, n = [], 0
    for t in tokens:
        if t == END:
            out.append(n)
            n = 0
        else:
            n += 1
    return out + ([n] if n else [])


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
@pytest.mark.parametrize("run", [2, 1024])
def test_counts_across_blocks(spark, tmp_path, monkeypatch, block, run):
    monkeypatch.setattr("depotflow.llm.token_files.RUN", run)
    rng = np.random.default_rng(5)
    files = {
        "a": rng.choice([1, 2, END], 50), "b": np.array([END, END, 3]), "c": np.array([], int), "d": np.ones(40, int),
        "e": np.append(np.ones(33, int), END), "f": np.array([END]),
    }
    for name, tokens in files.items():
        (tmp_path / f"{name}.bin").write_bytes(tokens.astype("uint16").tobytes())
    got = count_tokens(token_files(spark, str(tmp_path)), END, "uint16", block).collect()
    for name, tokens in files.items():
        own = sorted((r for r in got if r["path"].endswith(f"/{name}.bin")), key=lambda r: r["ordinal"])
        assert [r["n_tokens"] for r in own] == lengths(tokens)
        assert [r["ordinal"] for r in own] == list(range(len(own)))
        starts = np.cumsum([0, *(r["n_tokens"] + 1 for r in own)])[:-1]
        assert [r["first_token"] for r in own] == starts.tolist()


def test_write_and_count(spark, tmp_path):
    encode = lambda texts: [[ord(c) % 9 for c in t] for t in texts]
    docs = spark.createDataFrame([(1, "abc"), (2, None), (2, ""), (None, "x" * 1000), (5, "é")], "doc_id long, text string").repartition(3)
    plan = write_token_files(docs, str(tmp_path / "out"), encode, END, "uint16").collect()
    counted = {(r["path"].rsplit("/")[-1], r["ordinal"]): r["n_tokens"] for r in count_tokens(token_files(spark, str(tmp_path / "out")), END, block_bytes=8).collect()}
    assert sorted(((r["doc_id"], counted[r["file"], r["ordinal"]]) for r in plan), key=str) == sorted([(1, 3), (2, 0), (2, 0), (None, 1000), (5, 1)], key=str)
    assert len(counted) == 5


def test_the_end_among_ids_and_broken_files_are_errors(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="end-of-document"):
        write_token_files(docs, str(tmp_path / "x"), lambda texts: [[END]] * len(texts), END).collect()
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple"):
        count_tokens(token_files(spark, str(tmp_path)), END).collect()


def test_same_counts_as_encoding(spark):
    folder = "/root/testdata/sf0.001"
    counted = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op4_token_counts"](spark, folder).collect()}
    assert counted == {r["doc_id"]: r["n_tokens"] for r in QUERIES["op10_byte_bpe"](spark, folder).collect()}
