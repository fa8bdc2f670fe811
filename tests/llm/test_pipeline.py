"""The pipeline and the registered queries on the smallest tables."""

import hashlib
import re

import corpus_pipeline
import __spark_entry__ as entry
from kpiloom.llm.spark import components, materialise

SMOKE = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def windows(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SMOKE), name)
        seen.append((name, docs))
    assert [n for n, _ in seen] == ["toxicity", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    assert all(d.columns == COLUMNS for _, d in seen[:-1])
    counts = [d.count() for _, d in seen[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[1] == counts[2] and counts[3] > 100
    unique = seen[1][1].collect()
    # Exact copies are gone, and only copies.
    assert len({r.text for r in unique}) == len(unique)
    gone = {r.doc_id for r in seen[0][1].collect()} - {r.doc_id for r in unique}
    for r in (r for r in seen[0][1].collect() if r.doc_id in gone):
        mine = windows(r.text.lower(), 5)
        assert any(len(mine & windows(k.text.lower(), 5)) >= 0.6 * len(mine) for k in unique) or not mine
    # No window of 50 words is left in two documents.
    left, total = set(), 0
    cut = seen[2][1].collect()
    for r in cut:
        mine = windows(r.text, 50)
        total += len(mine)
        left |= mine
        assert r.n_chars == len(r.text)
    before = {r.doc_id: r.text for r in unique}
    assert all(r.text == before[r.doc_id] or len(r.text) < len(before[r.doc_id]) for r in cut)
    # Leaks go, all else stays.
    bench = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    leak = {r.doc_id for r in cut if any(b in " ".join(r.text.lower().split()) for b in bench)}
    kept = {r.doc_id for r in seen[3][1].collect()}
    assert not leak & kept and len(kept) >= len(cut) - len(leak) - 3
    assert {r.doc_id for r in seen[4][1].collect()} == kept


def test_edges_pass_through(spark, edge_docs, no_docs):
    docs, empty = edge_docs, no_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = materialise(stage(spark, docs, SMOKE), "edges"), stage(spark, empty, SMOKE)
        assert docs.columns == edge_docs.columns and empty.count() == 0
    got = [(r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest()[:4]) for r in docs.collect()]
    assert len(got) == len(set(got)) and {1, 2, 3, 4, 5, 9, 10, 11, None} <= {i for i, _ in got} and 6 not in {i for i, _ in got}
    assert {i for i, _ in got} & {7, 8} == {7}


def test_every_operator_is_registered(spark):
    names = [q.split("_")[0] for q in entry.queries() if q.startswith("op")]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000, 2000), (3001, 3000), (3000, 3001)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)} | {3000: 3000, 3001: 3000}
    assert got == want
