import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import text as T
from strata.llm.suffix_array import suffix_array

from . import brute


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab É_1.\n-İ漢", max_size=40), min_size=1, max_size=6))
def test_shingles_match_words(texts):
    hashes, offsets = T.shingle_hashes(texts, 5)
    seen = {}
    for i, t in enumerate(texts):
        w = brute.words(t)
        grams = [tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))] if w else []
        own = hashes[offsets[i]:offsets[i + 1]].tolist()
        assert len(own) == len(grams)
        for g, h in zip(grams, own):
            assert seen.setdefault(g, h) == h
    assert len(set(seen.values())) == len(seen)


def test_null_and_long_texts():
    long = "word " * 300_000
    sets = list(T.shingle_sets([None, "", "###", "one two", long], 5))
    assert [len(s) for s in sets] == [0, 0, 0, 1, 1]


def test_range_hashes_depend_on_content_only():
    values = np.array([5, 7, 5, 7, 9], dtype=np.uint64)
    a = T.range_hashes(values, np.array([0, 2, 1]), np.array([2, 4, 3]), 1)
    assert a[0] == a[1] != a[2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(symbols):
    text = [*symbols, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_one_symbol():
    text = [1] * 5000 + [0]
    assert suffix_array(text) == list(range(5000, -1, -1))
    assert suffix_array([]) == []
