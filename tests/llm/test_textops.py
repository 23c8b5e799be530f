import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from valuora.llm import textops as T

TEXT = st.one_of(st.none(), st.text(alphabet="aAbB é€😀\t\n\x0b.", max_size=60))


def ref_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def ref_set(t, width):
    w = ref_words(t)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*(w[k:] for k in range(width)), strict=False))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=12), st.integers(1, 6))
def test_shingles_are_the_brute_force_sets(texts, width):
    sh, heads = T.text_shingles(pa.array(texts, pa.string()), width)
    sets = [set(sh[a:b].tolist()) for a, b in zip(heads[:-1], heads[1:], strict=True)]
    want = [ref_set(t, width) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(sets[i] & sets[j]) == len(want[i] & want[j])
    for a, b in zip(heads[:-1], heads[1:], strict=True):
        assert (np.diff(sh[a:b].astype(object)) > 0).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_words_and_code_points(texts):
    col = pa.array(texts, pa.string())
    data, offsets = T.text_bytes(col)
    starts, ends, first = T.words(data, offsets)
    got = [[bytes(data[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)]
           for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    cp, at = T.codepoints(col)
    assert ["".join(map(chr, cp[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)] == [t or "" for t in texts]


def test_slices_keep_all_rows_in_order():
    b = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 100, 1, 1)] + [None], "k": list(range(6))})
    got = [k for s in T.slices(b, "text", limit=6) for k in s.column("k").to_pylist()]
    assert got == list(range(6))


def test_bit_filter_has_no_false_negatives(spark):
    ids = spark.range(0, 3_000_000, 997).selectExpr("id * 1000003 AS id")
    f = T.BitFilter.of(ids, "id")
    assert f.has(np.arange(0, 3_000_000, 997) * 1000003).all()
    assert f.has(np.arange(10**15, 10**15 + 10_000)).mean() < 0.01
