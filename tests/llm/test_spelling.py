import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kpiloom.llm.spelling import Spelling, rotations, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, cfg):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = None if i is None or not cfg.typo_every else zlib.crc32(f"{i}:{w}".encode())
            if h is not None and h % cfg.typo_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    words = {w: c for w, c in n.items() if len(w) >= cfg.min_length and c >= cfg.min_count}
    met = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in met.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= cfg.times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(met[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("letters,times,seed", [("ab", 2, 2), ("abcé", 1.5, 4), ("aß", 10, 5)])
def test_random_against_brute_force(make_docs, letters, times, seed):
    rng = random.Random(seed)       # rows that hold forms of forms
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(80)]
    rows = [(i, " ".join(rng.choice(pool[:rng.choice([3, 20, 80])]) for _ in range(40))) for i in range(40)]
    cfg = Spelling(min_length=3, min_count=1, times=times, typo_every=5)
    got = result(variants(make_docs(rows).repartition(3), cfg))
    assert got == brute(rows, cfg) and any(r[1] for r in got) and any(r[1] != r[2] for r in got if r[1])


def test_chain_of_forms(make_docs):
    words = ["abcdefgh"] * 2000 + ["abcdefgx"] * 200 + ["abcdefyx"] * 20 + ["abcdezyx"] * 2
    got = {r.word: r.root for r in variants(make_docs([(1, " ".join(words))]), Spelling(typo_every=0)).collect()}
    assert got == dict.fromkeys(["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx"], "abcdefgh")


def test_edges(edge_docs, make_docs):
    from tests.llm.conftest import EDGES
    more = [*EDGES, (20, "Überaus überaus übereaus ÜBERAUS mississippi missisippi mississippi"), (21, None), (22, "aaaaaaaa aaaaaaa aaaaaaa aaaaaaaa")]
    cfg = Spelling(min_length=4, typo_every=2)
    assert result(variants(make_docs(more), cfg)) == brute(more, cfg)


def test_empty_table(no_docs):
    assert variants(no_docs).collect() == []


def test_a_group_is_no_larger_than_the_alphabet(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    words = spark.createDataFrame([(f"prefix{a}suffix", 1) for a in [*letters, ""]], "word string, n long")
    assert rotations(words).groupBy("prefix").count().agg(F.max("count")).first()[0] == len(letters) + 1 == 91
