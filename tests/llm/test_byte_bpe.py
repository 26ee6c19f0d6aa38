import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from depotflow.llm.byte_bpe import digests, encode_decode, load

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


PIECES = st.sampled_from(
    ["the", " there", "ab", "'s", " 'll", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "é", "漢字", "🙂", "é",
     "²٣", "\x00", ".!", "<|endoftext|>", "<|endof", "zzzzzzzzzz", "�"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join))
def test_encodes_and_decodes_as_the_library(library, text):
    want = library.encode(text, add_special_tokens=False).ids
    ids = load(PATH).encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert load(PATH).decode(ids) == library.decode(want, skip_special_tokens=False)


def test_long_word_and_full_memory(library, monkeypatch):
    text = "ab" * 20_000
    bpe = load(PATH)
    bpe.words.most, before = 0, bpe.words.most
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    bpe.words.most = before


def test_rows_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "Hello there", "x"), (1, "Hello there", "x"), (2, None, None), (None, "", "y"), (3, "á " * 500, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(encode_decode(docs, PATH).collect(), key=str)
    assert len(got) == 5 and {r["decoded"] for r in got} == {r[1] or "" for r in rows}
    out = {r["doc_id"]: r for r in digests(docs, PATH).collect()}
    assert out[2]["n_tokens"] == 0 and out[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert out[None]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert digests(docs.limit(0), PATH).count() == 0
