import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiloom.llm import decontaminate
from kpiloom.llm import pitmanyor as py
from kpiloom.llm.decontaminate import Latent, common_words, leading_directions, leaks, without_leaks
from kpiloom.llm.pitmanyor import PitmanYor, log_stirling, perplexity, score_texts, seat
from kpiloom.llm.topk import TopK, top_k
from kpiloom.llm.toxicity import Toxicity, fit, fit_ordinal, severity, without_toxic
from kpiloom.llm.urls import UrlFilter, judged, segmented, viterbi

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMOKE = "/root/testdata/sf0.001"


# --- language model -------------------------------------------------------------------------------

def base_scores(rows):
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, WORD.findall((t or "").translate(low)) + [None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted([(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                   for i, ws in tokens], key=str)


@pytest.mark.parametrize("cfg", [PitmanYor(), PitmanYor(bucket_bytes=20_000, block_words=3000)])
def test_base_scores_and_finite_model(edge_docs, cfg):
    from tests.llm.conftest import EDGES
    got = score_texts(edge_docs, cfg).collect()
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], key=str) == base_scores(EDGES)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_model_beats_the_base_on_held_out_text(spark, no_docs):
    scored = score_texts(spark.read.parquet(f"{SMOKE}/documents.parquet"), PitmanYor(bucket_bytes=200_000)).cache()
    model, base = ({r.held_out: r.perplexity for r in perplexity(scored, c).collect()} for c in ("score", "base_score"))
    assert model[True] < 0.6 * base[True] and model[False] < model[True]
    assert score_texts(no_docs).collect() == []


def test_known_words_of_probes(make_docs):
    """A probe counts its known words and the end; every score is a log probability."""
    rng = random.Random(1)
    words = ["a", "b", "c", "d"]
    rows = [(i, " ".join(rng.choice(words[:2 + i % 3]) for _ in range(30))) for i in range(0, 60) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 7 == 2]
    probes = [(held[k], x) for k, x in enumerate(["", *words, "never"])]
    got = {r.doc_id: r for r in score_texts(make_docs(rows + probes)).collect()}
    for k, x in enumerate(["", *words, "never"]):
        assert got[held[k]].n_known == (1 if x in ("", "never") else 2) and got[held[k]].score < 0


@pytest.mark.parametrize("buckets", [1, 16])
def test_predictions_sum_to_one(make_docs, buckets):
    """Known words and the unknown one have probability one together, in spread contexts as well."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(["the", rng.choice(words), rng.choice(words[:9])]) for _ in range(40))) for i in range(400)]
    cfg = PitmanYor(burn_in=1, samples=2, exact_customers=16)
    docs = make_docs(rows).select(F.col("doc_id").alias("id"), "text")
    tokens, hot = py.frequent_contexts(docs, cfg, buckets)
    assert len(hot) >= (3 if buckets > 1 else 0)
    pairs = docs.mapInArrow(py._pairs(cfg, buckets, hot), "bucket long, block long, blob binary").toArrow()
    key = lambda x: (pa.scalar(x),)
    of = lambda table, c, x: table.filter(pc.equal(table[c], x))
    used = sorted(set(pairs["bucket"].to_pylist()))
    asked = pa.concat_tables([py._ask(cfg, buckets, hot, tokens)(key(x), of(pairs, "bucket", x)) for x in used])
    answers = pa.concat_tables([py._parent(cfg, buckets)(key(x), of(asked, "wbucket", x)) for x in sorted(set(asked["wbucket"].to_pylist()))])
    for c in ("words", "customers", "tables"):
        answers = answers.append_column("all_" + c, pa.array([sum(answers[c].to_pylist())] * len(answers), pa.int64()))
    seats = pa.concat_tables([py._seats(cfg, buckets, hot)(key(x), of(pairs, "bucket", x), of(answers, "bucket", x)) for x in used])
    total = seats.group_by(["context", "sample"]).aggregate([("customers", "sum"), ("tables", "sum")])
    total = {(c, i): (n, t) for c, i, n, t in zip(*(total[x].to_pylist() for x in ("context", "sample", "customers_sum", "tables_sum")), strict=True)}
    mass, seen, everything, rest = Counter(), {}, {}, {}
    for x in used:
        b = py._Bucket(of(pairs, "bucket", x), cfg, hot)
        _, parent, _ = py._shared(b, of(answers, "bucket", x), cfg, buckets)
        everything |= dict(zip(b.words.tolist(), parent.tolist(), strict=True))
        names = np.sort(b.contexts[b.wide])
        wide = [names, np.array([total[int(c), 0][0] for c in names], np.int64),
                *[np.array([total[int(c), i][1] for c in names], np.int64) for i in range(cfg.samples)]] if len(names) else []
        for c, w, p in zip(b.contexts[b.house].tolist(), b.words[b.word].tolist(), py.predictions(b, parent, wide, x).tolist(), strict=True):
            mass[c] += p
            seen.setdefault(c, set()).add(w)
        # What a restaurant gives to its parent, from the same seats.
        tables = [b.totals(u + v) for u, v in zip(b.samples(parent, x, False), b.samples(parent, x, True), strict=True)]
        for j, c in enumerate(b.contexts.tolist()):
            many, opened = (total[c, 0][0], [total[c, i][1] for i in range(cfg.samples)]) if b.wide[j] else (b.totals(b.count)[j], [t[j] for t in tables])
            rest[c] = np.mean([(cfg.strength + cfg.discount * t) / (cfg.strength + many) for t in opened])
    known = sum(everything.values())
    assert known < 1                                        # the rest is the unknown word's
    for c, m in mass.items():
        unseen = 1 - sum(everything[w] for w in seen[c])    # by the parent, with the unknown word
        assert abs(m + rest[c] * unseen - 1) < 1e-9
    spread = [c for c, n in Counter(c for x in used for c in set(py._Bucket(of(pairs, "bucket", x), cfg, hot).contexts.tolist())).items() if n > 1]
    assert len(spread) >= (2 if buckets > 1 else 0)


def test_stirling_numbers_and_seating_match_the_restaurant_process():
    d, s, p, n = 0.5, 1.0, 0.3, 6
    log_s = log_stirling(d, n)
    assert np.isclose(np.exp(log_s[3, 2]), 3 * (1 - d)) and np.isclose(np.exp(log_s[2, 1]), 1 - d)
    weight = np.array([np.prod([s + d * i for i in range(t)]) * np.exp(log_s[n, t]) * p**t for t in range(1, n + 1)])
    many = 20000
    got = seat(np.full(many, n), np.ones(many, np.int64), np.arange(many), np.ones(many), np.full(many, p), d, s, 64, np.random.default_rng(0))
    assert np.abs(np.bincount(got, minlength=n + 1)[1:] / many - weight / weight.sum()).max() < 0.015
    big = seat(np.full(50, 5000), np.ones(50, np.int64), np.arange(50), np.ones(50), np.full(50, p), d, s, 64, np.random.default_rng(0))
    assert 1 <= big.min() and 5 < big.mean() < 20


# --- url filter -----------------------------------------------------------------------------------

def test_rules_hosts_and_paths(spark):
    urls = {1: ("http://A.Example.NET/en/x?q=1", "a.example.net", "/en/x", "example.net/en/", "allow"),
            2: ("https://b.net/x#y", "b.net", "/x", "net/", "block"), 3: ("https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
            4: ("https://www.example.com/de/1", "www.example.com", "/de/1", "example.com/de/", "block"),
            5: ("https://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"), 6: (None, "", "", None, "allow"), 7: ("no scheme", "", "", None, "allow"),
            8: ("http://b.net", "b.net", "", None, "allow"), 9: ("s://h://x/y", "h:", "//x/y", None, "allow"), 10: ("http://b.net?/x", "b.net", "", None, "allow"),
            11: ("http://cheap-pills.example.com/en/1", "cheap-pills.example.com", "/en/1", None, "block"),
            12: ("http://teamugs.example.com/en/1", "teamugs.example.com", "/en/1", None, "allow")}
    html = "<p class='cheap'>mugs and mugs, cheap tea</p>"
    rows = [(i, u[0], html, "h", 1, "t") for i, u in urls.items()] * 2 + [(None, "http://fine.example.org/", None, "h", 1, "t")] * 5
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, n int, token string")
    got = judged(pages).collect()
    assert len(got) == len(rows)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got if r.page_id} == {i: u[1:] for i, u in urls.items()}
    assert judged(pages.limit(0)).collect() == []


def test_segmentation_prefers_frequent_words():
    counts = {"cheap": 50, "mugs": 30, "che": 2, "apmugs": 1}
    assert viterbi("cheapmugs", counts, 1000) == ["cheap", "mugs"] and viterbi("", {}, 1) == []
    best = max((sum(math.log(counts.get(w, 0) / 1000) if w in counts else math.log(10 / 1000) - len(w) * math.log(10) for w in s), s)
               for s in (["cheap", "mugs"], ["cheapmugs"], ["che", "apmugs"], ["cheap", "mug", "s"]))
    assert best[1] == ["cheap", "mugs"]


def best_split(name, counts, total):
    """The largest log probability over all ways to cut the name."""
    piece = lambda w: math.log(counts[w] / total) if counts.get(w) else math.log(10 / total) - len(w) * math.log(10)
    return max(sum(piece(name[a:b]) for a, b in zip((0, *cut), (*cut, len(name)), strict=True))
               for k in range(len(name)) for cut in itertools.combinations(range(1, len(name)), k)), piece


def test_segmentation_against_all_splits():
    rng = random.Random(5)
    for _ in range(60):
        counts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))): rng.randint(1, 9) for _ in range(8)}
        name, total = "".join(rng.choice("abc") for _ in range(rng.randint(1, 10))), rng.choice([50, 1000, 10**6])
        best, piece = best_split(name, counts, total)
        got = viterbi(name, counts, total)
        assert "".join(got) == name and math.isclose(sum(map(piece, got)), best, rel_tol=1e-9)
    long = "a" * 40
    assert viterbi("b" + long + "c", {long: 3, "b": 5, "c": 5}, 100) == ["b", long, "c"]


def test_names_of_any_length_are_cut_alike(spark):
    """Pieces, words longer than the anchor, and a very long host."""
    rng = random.Random(6)
    counts = {"".join(rng.choice("abcd") for _ in range(n)): rng.randint(1, 50) for n in [2, 3, 3, 4, 5, 6, 9, 30, 31, 41]}
    words = list(counts)
    names = sorted({"".join(rng.choice([rng.choice(words), "abcd"[rng.randrange(4)]]) for _ in range(rng.randint(1, 40))) for _ in range(40)})
    names.append("".join(rng.choice(words) for _ in range(2500)))
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.name: r.words for r in segmented(spark.createDataFrame([(x,) for x in names], "name string"), table, UrlFilter(anchor=4, piece=16)).collect()}
    assert got == {x: viterbi(x, counts, float(sum(counts.values()))) for x in names}


def test_bayes_scores_recomputed(spark):
    hosts = ["tea-mugs.example.com", "casino.example.com", "best-casino.example.com", "tea.example.org", "best-tea.example.org"]
    pages = [(i, f"http://{hosts[i % 5]}/{['bonus', 'shop/12', 'bonus/x'][i % 3]}") for i in range(40)]
    got = {r.page_id: r.score for r in judged(spark.createDataFrame([(i, u, None) for i, u in pages], "page_id long, url string, html string")).collect()}
    split = lambda x: re.findall("[a-z]+", x)
    rows = [(i, split(u.split("/")[2]), ["/" + ("<number>" if t.isdigit() else t) for t in re.findall("[a-z]+|[0-9]+", u.split("/", 3)[3])]) for i, u in pages]
    blocked = lambda h: any(x in UrlFilter().seeds for x in h)
    seen = [Counter(t for _, h, p in rows if blocked(h) == k for t in h + p) for k in (True, False)]
    kinds = len(seen[0] | seen[1])
    prior = math.log((sum(blocked(h) for _, h, _ in rows) + 1) / (sum(not blocked(h) for _, h, _ in rows) + 1))
    weight = lambda t: math.log((seen[0][t] + 1) / (sum(seen[0].values()) + kinds + 1)) - math.log((seen[1][t] + 1) / (sum(seen[1].values()) + kinds + 1))
    assert got == {i: pytest.approx(prior + sum(map(weight, h + p))) for i, h, p in rows}


# --- exact top-k ----------------------------------------------------------------------------------

def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(300)]
    data += [(300 + i, data[50][1]) for i in range(40)]                                          # ties
    data += [(400, None), (450, []), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, data[0][1]), (500, [1.0, 2.0]), (501, [2.0, 2.0])]
    rows = [(i, v, 0, "x", 1) for i, v in data]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, rank int")
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, TopK(query_block=3, block=32, chunk=4, pivots=5)).collect())
    ok = {i: [math.floor(256 * x) for x in v] for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in ok if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ok[q], v, strict=True)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == sorted(want)
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_with_very_many_dimensions(spark):
    """Dimensions without pivots, and an id that repeats with two dimensions."""
    dim = F.col("vec_id") % 1200 + 1
    df = spark.range(2400).withColumnRenamed("id", "vec_id").union(spark.createDataFrame([(600,)], "vec_id long"))
    nth = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.lit(1)))
    df = df.withColumn("size", F.when(nth == 2, F.lit(7)).otherwise(dim)).withColumn(
        "embedding", F.expr("transform(sequence(1, size), i -> cast(pmod(hash(vec_id, i), 9) - 4 as float))"))
    rows = [(r.vec_id, [int(256 * x) for x in r.embedding]) for r in df.collect()]
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, TopK(k=2, pivots=3, pivot_bytes=20_000, held_bytes=1 << 20)).collect())
    ask, want = {}, []
    for i, v in sorted(rows):
        if i % 50 == 0:
            ask.setdefault(i, v)
    for q, v in ask.items():
        scores = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), i) for i, x in rows if i != q and len(x) == len(v))[:2]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == sorted(want)


# --- toxicity -------------------------------------------------------------------------------------

def test_severity_separates_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0), labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    got = severity(docs, fit(docs, train)).withColumnRenamed("toxic", "judged").join(test, "doc_id").collect()
    good = sum(r.judged == (r.toxic == 1) for r in got) / len(got)
    assert good > 0.9
    means = [np.mean([r.expected_severity for r in got if r.toxic == y]) for y in (0, 1)]
    assert means[1] > 5 * means[0]


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None), (99, 1), (4, 0), (5, 0)], "doc_id long, toxic int")
    model = fit(edge_docs, labels)
    got = severity(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.expected_severity <= 3 for r in got)
    assert without_toxic(edge_docs, model).columns == edge_docs.columns
    for few in (labels.limit(0), labels.where("toxic = 0")):
        assert all(not r.toxic or r.expected_severity > 0 for r in severity(edge_docs, fit(edge_docs, few)).collect())
    assert severity(no_docs, fit(no_docs, labels)).collect() == [] == without_toxic(no_docs, model).collect()


def test_short_toxic_words_count(spark, make_docs):
    rng = random.Random(3)
    words = [f"plain{i}" for i in range(300)]
    text = lambda bad: " ".join(rng.choice(["zog", "Vex"]) if bad and rng.random() < 0.2 else rng.choice(words) for _ in range(40))
    docs = make_docs([(i, text(i % 4 == 0)) for i in range(800)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = [r for r in severity(docs, fit(docs, labels)).collect() if r.doc_id >= 400]
    assert sum(r.toxic == (r.doc_id % 4 == 0) for r in got) > 0.97 * len(got)


def test_nothing_is_rejected_when_nothing_was_learnt(spark, edge_docs, make_docs):
    shape = "doc_id long, toxic int"
    for labels in ([], [(5, 0)], [(4, 0), (5, 0), (6, 0), (7, 0)], [(4, 1), (5, 1)], [(4, 0), (5, 1)]):
        model = fit(edge_docs, spark.createDataFrame(labels, shape))
        assert without_toxic(edge_docs, model).count() == edge_docs.count()
        assert not any(r.toxic for r in severity(edge_docs, model).collect())
    docs = make_docs([(i, "bad words here" if i % 2 else "good words there") for i in range(200)] + [(1000, None), (1001, "")])
    model = fit(docs, spark.createDataFrame([(i, i % 2) for i in range(200)], shape))
    assert {r.doc_id for r in without_toxic(docs, model).collect()} == {*range(0, 200, 2), 1000, 1001}


def test_ordinal_thresholds_are_shared_and_ordered():
    rng = np.random.default_rng(0)
    x = rng.normal(size=2000)
    grade = np.digitize(2 * x + rng.logistic(size=2000), [-1.0, 1.0, 3.0])
    w, cuts = fit_ordinal(np.arange(2000), np.zeros(2000, int), x, grade, 1, Toxicity())
    assert abs(w[0] - 2) < 0.25 and np.abs(cuts - [-1, 1, 3]).max() < 0.3 and (np.diff(cuts) > 0).all()


# --- decontamination ------------------------------------------------------------------------------

def test_leaks_and_paraphrases_are_found_and_clean_texts_left(spark, make_docs):
    rng = random.Random(8)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(3000)]
    text = lambda n: [rng.choice(common) if rng.random() < 0.6 else rng.choice(rare) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(15, 60)))) for i in range(30)] + [(100, None), (101, ""), (None, "c1 c2"), (102, "q1 q2 q3"), (0, "zz1 zz2 zz3 zz4 zz5 zz6 zz7 zz8 zz9")]
    docs, want = [], set()
    for i in range(200):
        words = text(rng.randint(1, 400))
        if i % 5 == 0:
            k = rng.randrange(30)
            copy = items[k][1].split()
            if i % 10 == 0:                                         # paraphrase: words changed, one left out
                for _ in range(len(copy) // 10):
                    copy[rng.randrange(len(copy) - 6)] = "changed"
                del copy[2]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() for w in copy]
            want.add((i, k))
        docs.append((i, " ".join(words)))
    docs += [(500, "say q1 q2 q3 now"), (501, "q1 q3 q2"), (502, None), (503, ""), (None, items[3][1])]
    want |= {(500, 102), (None, 3)}
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, id string")
    for cfg in (Latent(), Latent(block_words=300)):
        got = {(r.doc_id, r.item_id) for r in leaks(make_docs(docs), bench, cfg).collect()}
        assert got == want
    kept = without_leaks(make_docs(docs), bench, Latent())
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want}
    assert leaks(make_docs([]), bench).collect() == [] == leaks(make_docs(docs), bench.limit(0)).collect()


def test_short_items_among_benchmark_words_are_found(spark, make_docs):
    rng = random.Random(9)
    words = [f"b{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([5, 6, 10])))) for i in range(400)]
    docs, want = [], set()
    for i in range(100):
        text = [rng.choice(words) for _ in range(150)]
        text[60:60] = items[i][1].split()
        docs.append((i, " ".join(text)))
        want.add((i, i))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for cfg in (Latent(), Latent(min_cosine=1.5)):                      # 1.5: no candidate by cosine at all
        assert {(r.doc_id, r.item_id) for r in leaks(make_docs(docs), bench, cfg).collect()} == want
        assert without_leaks(make_docs(docs), bench, cfg).count() == 0


def test_long_items_are_read_to_their_end(spark, make_docs):
    """A short rest is read with what precedes it, and only the end of an item is its answer."""
    words = [f"q{i}" for i in range(134)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(f"r{i}" for i in range(64)))], "item_id long, text string")
    (items, passages, ends), = decontaminate._benchmark_blocks(bench.orderBy("item_id"), Latent(), "item_id", "text")
    assert sorted(zip(items, map(len, passages), ends, strict=True)) == [(1, 64, False), (1, 64, False), (1, 64, True), (2, 64, True)]
    rng = random.Random(2)
    noise = lambda n: " ".join(f"n{rng.randrange(400)}" for _ in range(n))
    docs = [(i, noise(150)) for i in range(40)]
    docs += [(100, f"{noise(40)} {' '.join(words[70:])} {noise(40)}"),                       # the end, word for word
             (101, f"{noise(40)} {' '.join(words[:50])} {noise(40)}"),                       # a middle passage without its last words
             (102, f"{noise(40)} {' '.join(f'r{i}' for i in range(58))} {noise(40)}")]       # an item without its answer
    assert {(r.doc_id, r.item_id) for r in leaks(make_docs(docs), bench).collect()} == {(100, 1), (101, 1)}


def test_segment_sums_against_a_loop():
    rng = np.random.default_rng(0)
    first = np.flatnonzero(np.append(True, rng.random(2000) < 0.3))
    index, value, source = rng.integers(0, 30, 2001), rng.random(2001), rng.random((30, 5))
    want = np.add.reduceat(source[index] * value[:, None], first, axis=0)
    assert np.allclose(decontaminate.segment_sums(first, index, value, source), want)


def test_common_words_is_a_longest_common_subsequence():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, last = [0], row
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        return row[-1]

    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint64), rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint64)
        found = common_words(a, b)
        assert found.sum() == length(a.tolist(), b.tolist())
        rest = iter(b.tolist())
        assert all(x in rest for x in a[found].tolist())            # the marked words occur in this order


def test_nystrom_directions_span_a_low_rank_matrix():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 40))
    omega = rng.normal(size=(40, 9))
    v = leading_directions(a.T @ a @ omega, omega, 5)
    assert np.allclose(v.T @ v, np.eye(5)) and np.allclose(a @ v @ v.T, a)
