import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from depotflow.llm.wordhash import ALNUM, NOT_SPACE, grams, slices, words
from tests.llm import data

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aA zé\n\t.!漢0🙂\x1c\x85", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, most):
    for letters, pattern in ((ALNUM, data.ALNUM), (NOT_SPACE, data.NOT_SPACE)):
        got, hashes = [], {}
        for part in slices(pa.array(texts, pa.string()), most):
            found = words(part, letters)
            raw = part.data.tobytes()
            for i in range(len(part)):
                at = range(found.bounds[i], found.bounds[i + 1])
                own = [raw[found.starts[j] : found.ends[j]].decode().translate(data.LOWER) for j in at]
                got.append(own)
                for j, w in zip(at, own):
                    assert hashes.setdefault(w, found.hashes[j]) == found.hashes[j]
        assert got == [data.words(t, pattern) for t in texts]
        assert len(set(hashes.values())) == len(hashes)


def test_grams_stay_within_rows():
    part = next(slices(pa.array(["a b c", "", "b c", None, "a b c d"])))
    found = words(part, ALNUM)
    hashes, starts = grams(found.hashes, found.bounds, 3)
    assert np.diff(starts).tolist() == [1, 0, 0, 0, 2]
    assert hashes[0] == hashes[1] != hashes[2]


def test_a_long_text_is_one_slice():
    parts = list(slices(pa.array(["x " * 5000, "y"]), 100))
    assert [len(p) for p in parts] == [1, 1]
