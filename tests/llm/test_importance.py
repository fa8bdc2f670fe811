import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from kpiloom.llm.importance import Importance, feature_spans, resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FIELDS = ("doc_id", "n_features", "weight", "score", "rank")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text, longest):
    w = WORD.findall(lower(text))
    return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, cfg):
    bucket = lambda g: zlib.crc32(g.encode()) % cfg.buckets
    s = Counter(bucket(g) for _, t in docs for g in grams(t, cfg.longest))
    t = Counter(bucket(g) for x in target for g in grams(x, cfg.longest))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + cfg.buckets) / ((s[b] + 1) * (T + cfg.buckets))))
    rows = []
    for i, text in docs:
        found = grams(text, cfg.longest)
        weight, score = sum(gain(bucket(g)) for g in found), None
        if i is not None:
            h = int(hashlib.sha256(f"{cfg.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(WORD.findall(lower(text)))])
    long_enough = sorted((r for r in rows if r[5] >= cfg.min_words and r[0] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for k, r in enumerate(long_enough[:cfg.percent * len(long_enough) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def result(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    return [(0, "Alpha beta--gamma, alpha!"), (1, None), (2, "w3 w4 w5 w6 ünï 42")]


@pytest.mark.parametrize("longest,ranges", [(1, 1000), (3, 7)])
def test_random_against_brute_force(spark, make_docs, target, longest, ranges):
    rng = random.Random(longest)
    docs = [(i, rng.choice(" .\n").join(rng.choice(["w%d" % rng.randint(0, 30), "Alpha", "BETA", "ünï", "x-y"]) for _ in range(rng.randint(0, 60))))
            for i in range(200)]
    cfg = Importance(longest=longest, buckets=97, percent=25, range_rows=ranges)
    got = resampled(make_docs(docs).repartition(3), spark.createDataFrame(target, "item_id long, text string"), cfg)
    assert result(got) == brute(docs, [t for _, t in target], cfg)


def test_edges(spark, edge_docs, target):
    from tests.llm.conftest import EDGES
    cfg = Importance(percent=50, min_words=1)
    got = resampled(edge_docs, spark.createDataFrame(target, "item_id long, text string"), cfg)
    assert result(got) == brute(EDGES, [t for _, t in target], cfg)


def test_empty_tables(spark, no_docs, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampled(no_docs, none).collect() == []
    docs = [(i, "a b c " * 10) for i in range(20)]
    assert result(resampled(make_docs(docs), none)) == brute(docs, [], Importance())


def test_spans_overlap():
    raw, spans = feature_spans("A  b--c", 2)
    assert raw == b"a b c" and [raw[s:e] for s, e in spans] == [b"a", b"b", b"c", b"a b", b"b c"]
    assert [raw[s:e] for raw, spans in [feature_spans("..É x..", 1)] for s, e in spans] == ["É".encode(), b"x"]
