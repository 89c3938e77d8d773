"""Vectorised words and hashes against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from auric.llm import text as t
from tests.llm.conftest import plain_words

texts = st.lists(st.text(alphabet="aB9 .\n\t|éß漢\U0001F600", max_size=30), max_size=8)


def run_of(items, **kw):
    return [(lo, hi, t.words(data, off, **kw)) for lo, hi, data, off in
            t.runs(pa.array(items, pa.string()))]


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_equal_plain_words(items):
    for lo, hi, w in run_of(items):
        for r in range(hi - lo):
            want = plain_words(items[lo + r])
            a, b = w.first[r], w.first[r + 1]
            assert [w.joined(i, i + 1).decode() for i in range(a, b)] == want
            assert list(w.hash[a:b]) == [run_of([x])[0][2].hash[0] for x in want]


@settings(max_examples=100, deadline=None)
@given(texts)
def test_groups_cut_words_from_punctuation(items):
    import re
    for lo, hi, w in run_of(items, kind=t.PIECES):
        for r in range(hi - lo):
            want = re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+|[^0-9A-Za-z\x80-\U0010FFFF\x20\x09-\x0D]+",
                              items[lo + r])
            assert w.counts[r] == len(want)


def test_runs_hold_whole_texts():
    items = ["a" * 10, None, "", "b" * 100, "c"]
    got = []
    for lo, hi, data, off in t.runs(pa.array(items, pa.string()), max_bytes=12):
        got += [data[off[k]:off[k + 1]].tobytes().decode() for k in range(hi - lo)]
    assert got == [x or "" for x in items]


def test_sliced_arrays_and_empty_batches():
    arr = pa.array(["zero", "one two", None, "three"], pa.string()).slice(1, 3)
    (_, _, data, off), = t.runs(arr)
    assert t.words(data, off).counts.tolist() == [2, 0, 1]
    assert list(t.runs(pa.array([], pa.string()))) == []


def test_shingles_do_not_cross_texts():
    (_, _, w), = run_of(["a b c", "d e", "", "f g h i"])
    h, at = t.shingles(w, 3)
    assert at.tolist() == [0, 5, 6] and len(set(h.tolist())) == 3


def test_lookup_finds_exactly_the_keys():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    look = t.Lookup(x[:1000])
    at, place = look.find(x)
    assert at.tolist() == list(range(1000)) and (look.keys[place] == x[:1000]).all()
    assert not len(t.Lookup(x[:0]).find(x)[0])
