import hashlib
import random
import re

import pytest

from kpiloom.llm.substring import Repeats, cut_text, glue, hot_minimizers, kept_words, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    seen, out = set(), []
    for i, t in sorted(set(rows)):
        w = WORD.findall(t or "")
        covered = [False] * len(w)
        for s in range(len(w) - size + 1):
            k = tuple(w[s:s + size])
            if k in seen:
                covered[s:s + size] = [True] * size
            seen.add(k)
        kept = [x for x, c in zip(w, covered, strict=True) if not c]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def result(df):
    return sorted({(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}, key=str)


@pytest.mark.parametrize("size,block", [(20, 1 << 20), (4, 50), (1, 7)])
def test_random_repeats_against_brute_force(make_docs, size, block):
    rng = random.Random(size)
    words = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(words) for _ in range(rng.randint(1, 60))] for _ in range(8)]
    rows = [(i, "  ".join(x for _ in range(rng.randint(0, 5)) for x in rng.choice([rng.choice(passages), [rng.choice(words) for _ in range(15)]])))
            for i in range(60)]
    df = kept_words(make_docs(rows).repartition(3), Repeats(window=size, block_words=block, bucket_bytes=2000))
    assert result(df) == sorted(brute(rows, size), key=str)


def test_phrase_of_a_third_of_rows(make_docs):
    """Its minimizers are hot: their edges are dealt out one by one, with the same result."""
    rng = random.Random(3)
    phrase = " ".join(f"p{i}" for i in range(15))
    noise = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(12))
    rows = [(i, f"{noise()} {phrase} {noise()}" if i % 3 == 0 else f"{noise()} {noise()}") for i in range(300)]
    rows += [(1000 + i, rows[3 * i][1]) for i in range(20)]
    docs, cfg = make_docs(rows).repartition(4), Repeats(window=20, block_words=400, bucket_bytes=2000, hot_edges=32)
    hot = hot_minimizers(docs.selectExpr("doc_id", "1L AS version", "text"), cfg, 30)
    assert 0 < len(hot) <= 15
    assert result(kept_words(docs, cfg)) == sorted(brute(rows, 20), key=str)


def test_edges(edge_docs):
    from tests.llm.conftest import EDGES
    got = result(kept_words(edge_docs, Repeats(window=20, block_words=5000)))
    want = brute([(i, t) for i, t in EDGES if i is not None and t is not None], 20)
    none = hashlib.sha256(b"").hexdigest()
    null_id = (None, 3, 0, hashlib.sha256(b"alpha beta gamma").hexdigest())
    assert got == sorted([*want, (1, 0, 0, none), null_id], key=str)
    assert kept_words(edge_docs, Repeats()).count() == len(EDGES)      # rows are never dropped


def test_empty_table(no_docs):
    assert kept_words(no_docs).collect() == []


def test_removal_keeps_columns_and_other_text(make_docs):
    passage = " ".join(f"p{i}" for i in range(25))
    df = make_docs([(1, f"first\n{passage} end"), (2, f"head  line\n{passage}\n  tail"), (3, None)])
    out = remove_repeats(df, Repeats(window=20))
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.id, r.version, r.node) for r in out.collect()}
    assert got == {1: (f"first\n{passage} end", "x", "y", "z"), 2: ("head  line tail", "x", "y", "z"), 3: (None, "x", "y", "z")}


def test_glue_and_cut():
    assert glue([5, 0, 4], [1, 2, 1], 3) == [(0, 8)] and glue([0, 9], [1, 1], 3) == [(0, 3), (9, 12)]
    assert cut_text("a b  c d", [(1, 2)]) == "a c d" and cut_text("a b", [(0, 2)]) == ""
