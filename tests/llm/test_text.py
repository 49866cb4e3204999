import numpy as np
import pyarrow as pa
import pytest
from brute import shingles as brute_shingles
from brute import words as brute_words
from hypothesis import given, settings
from hypothesis import strategies as st
from tidemark.llm import _text as X

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=30), st.text(alphabet="aB1é -.\n", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, limit):
    before = X.SLICE_BYTES
    X.SLICE_BYTES = limit  # hashes don't depend on how words are taken together
    try:
        w = X.words(*X.string_buffers(pa.array(texts, pa.string())))
    finally:
        X.SLICE_BYTES = before
    raw = w.packed.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(w.place[f:t], w.place[f + 1 : t + 1], strict=True)] for f, t in zip(w.first[:-1], w.first[1:], strict=True)]
    want = [brute_words(t) for t in texts]
    assert got == want
    flat = [x for ws in want for x in ws]
    assert w.hashes.tolist() == X.words(*X.string_buffers(pa.array(texts, pa.string()))).hashes.tolist()
    assert len(set(w.hashes.tolist())) == len(set(flat))


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 6))
def test_shingles_are_sets(texts, n):
    row, value = X.shingles(X.words(*X.string_buffers(pa.array(texts, pa.string()))), n)
    assert np.bincount(row, minlength=len(texts)).tolist() == [len(brute_shingles(t, n)) for t in texts]
    assert len(set(zip(row.tolist(), value.tolist(), strict=True))) == len(row)


@pytest.mark.parametrize("limit", [1, 5, 100])
def test_slices_cover_all_rows(limit):
    texts = pa.array(["a" * k for k in (0, 3, 50, 0, 0, 7, 2, 2)])
    got = list(X.slices(texts, limit))
    assert [a for a, _ in got] == [0, *[b for _, b in got[:-1]]] and got[-1][1] == len(texts)
    assert list(X.slices(pa.array([], pa.string()))) == []
