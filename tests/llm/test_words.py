import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm.blobs import pack, unpack
from kpiloom.llm.words import slices, window_hashes, word_hash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \t\n\x0b漢", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_are_runs_without_ascii_space(texts, limit):
    got = [[] for _ in texts]
    for w in slices(pa.array(texts, pa.string()), False, limit):
        for h, d in zip(w.hash.tolist(), w.doc.tolist(), strict=True):
            got[d].append(h)
    assert got == [[word_hash(x) for x in WORD.findall(t or "")] for t in texts]


def test_lower_cases_only_ascii():
    assert word_hash("ABÉ", True) == word_hash("abÉ", True) != word_hash("abé", True)


def test_window_hashes_follow_content_and_order():
    h = np.array([5, 6, 7, 5, 6, 7, 6, 5], np.uint64)
    w = window_hashes(h, 3)
    assert w[0] == w[3] and len(set(w.tolist())) == 5 and len(window_hashes(h, 9)) == 0


@given(st.lists(st.integers(0, 2**63), max_size=20), st.lists(st.integers(0, 60000), max_size=9))
def test_blobs_round_trip(a, b):
    x, y = unpack(pack(np.array(a, np.uint64), np.array(b, np.uint16)))
    assert x.tolist() == a and y.tolist() == b and y.dtype == np.uint16
