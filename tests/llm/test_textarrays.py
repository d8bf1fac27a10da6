import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from meterlake.llm import textarrays as ta

from .helpers import shingles, words

TEXT = st.text(st.sampled_from(list("abAB \t\n\x0b.,é 日")), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40))
def test_words_and_shingles_equal_plain_python(texts, limit):
    column = ta.utf8(pa.array(texts, pa.string()))
    got, sets = {}, {}
    for first, last, hashes, at in ta.words(column, limit):
        for i in range(last - first):
            got[first + i] = hashes[at[i]:at[i + 1]].tolist()
    for first, last, value, at in ta.shingle_sets(column, 5, limit):
        for i in range(last - first):
            sets[first + i] = value[at[i]:at[i + 1]].tolist()
    for i, text in enumerate(texts):
        assert got[i] == [ta.word_hash(w.encode()) for w in words(text)]
        assert sets[i] == sorted(sets[i]) and len(sets[i]) == len(shingles(text))


def test_equal_shingles_have_equal_hashes_wherever_they_stand():
    a, b = "one two three four five six", "zero ONE two three four FIVE"
    (_, _, value, at), = ta.shingle_sets(ta.utf8(pa.array([a, b])))
    assert len(np.intersect1d(value[:at[1]], value[at[1]:])) == 1
