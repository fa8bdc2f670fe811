import random
import re

import numpy as np
import pytest

from kpiloom.llm.minhash import MinHash, _crossing, load_set, near_duplicates, signatures, store_set
from kpiloom.llm.words import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    """{id: (set size, smallest id reachable)} by comparing all pairs."""
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append((i, frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])))
    comp = {k: k for k in range(len(sets))}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            if x and y and i is not None and j is not None and 100 * len(x & y) >= 80 * len(x | y):
                comp[root(a)] = root(b)
    groups = {}
    for a, (i, _) in enumerate(sets):
        groups.setdefault(root(a), []).append(i)
    return sorted(((i, len(s), None if i is None else min(groups[root(a)])) for a, (i, s) in enumerate(sets)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [2, 5])
def test_edges_against_brute_force(edge_docs, size):
    from tests.llm.conftest import EDGES
    df = near_duplicates(edge_docs, MinHash(shingle=size))
    assert result(df) == brute(EDGES, size)
    assert {r.doc_id: r.kept for r in df.collect() if r.doc_id in (4, 6)} == {4: True, 6: False}


def test_chains_and_hot_groups_against_brute_force(make_docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(12):
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(rng.choice([1, 2, 25])):          # each copy changes the one before: chains
            rows.append((n, " ".join(text)))
            n += 1
            text = list(text)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(60)] = rng.choice(words)
    rng.shuffle(rows)
    df = near_duplicates(make_docs(rows), MinHash(shingle=2, block=8))
    assert result(df) == brute(rows, 2)


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_densified_bins_agree_as_often_as_the_sets_overlap():
    base = mix(np.arange(1000, dtype=np.uint64))
    a, b = np.sort(base[:900]), np.sort(base[100:])
    sig = signatures([a, b, base[:3], np.sort(base[:0])], 4000)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.03
    assert len(np.unique(sig[2])) == 3 and (sig[3] == ~np.uint64(0)).all()


def test_stored_sets_keep_their_order():
    import pyarrow as pa
    s = np.sort(mix(np.arange(50, dtype=np.uint64)))
    assert (load_set(pa.scalar(store_set(s), pa.binary())) == s >> np.uint64(16)).all()


def test_only_a_shared_bucket_counts_as_met():
    """Signature bytes that agree in an earlier band by chance don't make it a shared bucket."""
    import pyarrow as pa
    cfg = MinHash(bands=2, rows=2, margin=0.3)
    members = store_set(np.sort(mix(np.arange(50, dtype=np.uint64))))

    def links(first_keys):
        rows = pa.table({"node": [1, 2], "comp": [1, 2], "n": [50, 50], "left": [True, True], "right": [True, True], "sig": [bytes(4)] * 2,
                         "met": pa.array([[k] for k in first_keys], pa.list_(pa.int64())), "members": pa.array([members] * 2, pa.binary())})
        return _crossing(cfg)((pa.scalar(9), pa.scalar(1)), rows).num_rows

    assert links([7, 8]) == 1 and links([7, 7]) == 0


def test_texts_that_share_an_id_are_judged_each_for_itself(spark, make_docs):
    from corpus_pipeline import drop_near_copies
    one, two, three = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = lambda t: t + " more"
    rows = [(5, one), (5, two), (5, three), (5, near(three)), (7, near(two)), (8, near(one)), (3, near(near(two)))]
    assert result(near_duplicates(make_docs(rows))) == brute(rows, 5)
    left = sorted((r.doc_id, r.text) for r in drop_near_copies(spark, make_docs(rows), "").collect())
    assert [x for x in left if x[1] not in (three, near(three))] == [(3, near(near(two))), (5, one)] and len(left) == 3
