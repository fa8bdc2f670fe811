"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

Features are every lower-cased word and its first 4, 5 and 6 bytes (stems that survive inflection),
valued log(1 + count). P(grade > k) = sigmoid(w.x - c_k): one weight vector for all thresholds, with
c_0 < c_1 < ...; the output is the expected grade, the sum of P(grade > k).

Fitting uses a bounded sample of labelled rows (``sample_rows``, the smallest hashes of the ids). A
feature is kept when it is tied to the grades: ``min_docs`` sample documents and a z-score of its
positive rate of ``min_z`` or more in size; at most ``max_features`` (a model size, chosen by
z-score). Counting and scoring run in Spark; the sample's reduced design matrix (a few numbers per
row) is fitted by gradient steps on the driver. Every document is scored on its whole text.

Labels of two classes are spread over grades by how many marked words a positive text holds
(``grade_at``), so the thresholds have an order to learn.

Defined cases: null or empty texts have no features and get the base rate; a text without a feature
of the model is not rejected, whatever the base rate, as nothing is known of it; labels without a document
or with null fields are ignored; of several labels of one id the largest counts; without any usable
label, or with one class only, nothing is learnt, every score is the prior and no text is rejected; repeated rows are
scored alike; null ids are scored too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.blobs import pack, unpack
from kpiloom.llm.words import Words, mix, range_hashes, slices

_U = np.uint64


@dataclass(frozen=True)
class Toxicity:
    sample_rows: int = 20_000
    max_features: int = 4096
    min_docs: int = 5
    min_z: float = 4.0
    stems: tuple[int, ...] = (4, 5, 6)
    grade_at: tuple[int, ...] = (3, 8)      # marked words from which a positive text has grade 2, 3
    ridge: float = 2e-5
    steps: int = 1000
    reject_from: float = 0.25               # P(grade > 0) from which a text is rejected


@dataclass(frozen=True)
class Model:
    features: np.ndarray      # sorted hashes
    weights: np.ndarray
    cuts: np.ndarray          # ascending thresholds

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score and threshold."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -500, 500)))

    def rejects(self, above: np.ndarray, hits: np.ndarray, cfg: Toxicity) -> np.ndarray:
        """``hits``: distinct features found in each text."""
        return (above[:, 0] >= cfg.reject_from) & (hits > 0)


def stems(w: Words, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, word) of the words and word beginnings of a slice (lower-cased when it was hashed)."""
    out, word = [mix(w.hash)], [np.arange(len(w.hash))]          # mixed: a whole word is not the stem of a longer one
    for k in sizes:
        at = np.flatnonzero(w.end - w.start >= k)
        s = w.start[at]
        out.append(range_hashes(w.sums, s, s + k))
        word.append(at)
    word = np.concatenate(word)
    return np.concatenate(out), w.doc[word], word


def marked_words(w: Words, sizes: tuple[int, ...], marked: np.ndarray, n: int) -> np.ndarray:
    """Marked words of each of ``n`` documents; a word counts by the share of its features that are ``marked`` (sorted hashes)."""
    h, _, word = stems(w, sizes)
    if not len(marked):
        return np.zeros(n)
    hit = marked[np.searchsorted(marked, h).clip(max=len(marked) - 1)] == h
    share = np.bincount(word, hit, len(w.hash)) / np.maximum(np.bincount(word, minlength=len(w.hash)), 1)
    return np.bincount(w.doc, share, n)


def counts(w: Words, sizes: tuple[int, ...], features: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of a slice, distinct; feature is an index when ``features`` is given."""
    h, doc, _ = stems(w, sizes)
    if features is not None:
        if not len(features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.searchsorted(features, h).clip(max=len(features) - 1)
        hit = features[at] == h
        key, n = np.unique((doc[hit] - w.first) * len(features) + at[hit], return_counts=True)
        return key // len(features) + w.first, key % len(features), n
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int, cfg: Toxicity) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model by full-batch Adam."""
    n, top = len(grade), int(grade.max(initial=0))
    share = np.array([(grade > k).mean() if n else 0.0 for k in range(max(1, top))]).clip(1e-6, 1 - 1e-6)
    w, cuts = np.zeros(n_features), -np.log(share / (1 - share))
    if not top:
        return w, cuts
    gaps = np.log(np.expm1(np.maximum(np.diff(cuts), 1e-3)))
    theta = np.concatenate([w, cuts[:1], gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, cfg.steps + 1):
        w, first, gaps = theta[:n_features], theta[n_features], theta[n_features + 1:]
        cuts = first + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(gaps)))])
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        score = np.bincount(rows, values * w[cols], n)
        hi, lo = sig(edges[grade + 1] - score), sig(edges[grade] - score)
        hi, lo = np.where(grade == top, 1.0, hi), np.where(grade == 0, 0.0, lo)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = -hi * (1 - hi) / p / n, lo * (1 - lo) / p / n
        g_cut = np.bincount(grade, d_hi, top + 1)[:top] + np.bincount(grade, d_lo, top + 1)[1:]
        g_gap = np.cumsum(g_cut[::-1])[::-1]
        g = np.concatenate([np.bincount(cols, values * -(d_hi + d_lo)[rows], n_features) + cfg.ridge * w,
                            g_gap[:1], g_gap[1:] * sig(gaps)])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    w, first, gaps = theta[:n_features], theta[n_features], theta[n_features + 1:]
    return w, first + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(gaps)))])


def fit(docs: DataFrame, labels: DataFrame, cfg: Toxicity = Toxicity(), id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """The model, from a bounded sample of the labelled documents."""
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(cfg.sample_rows)       # at most sample_rows rows of 12 bytes
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "id").select("id", "text", "y")

    def tally(batches):
        for batch in batches:
            y = batch.column(2).to_numpy() > 0
            keys, n, pos = [], [], []
            for w in slices(batch.column(1), True):
                doc, h, _ = counts(w, cfg.stems)
                u, at = np.unique(h, return_inverse=True)
                keys.append(u)
                n.append(np.bincount(at, minlength=len(u)))
                pos.append(np.bincount(at, y[doc].astype(float), len(u)))
            if keys:
                u, at = np.unique(np.concatenate(keys), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.bincount(at, np.concatenate(n)).astype(np.int64)),
                                                  pa.array(np.bincount(at, np.concatenate(pos)).astype(np.int64))], ["h", "n", "pos"])

    total = rows.agg(F.count("*").alias("n"), F.sum((F.col("y") > 0).cast("long")).alias("pos")).first()
    n, pos = total["n"], total["pos"] or 0
    if not n or not pos or pos == n:
        return Model(np.zeros(0, _U), np.zeros(0), np.array([np.log((n - pos + 1) / (pos + 1))]))
    p = pos / n
    z = (F.col("pos") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)))
    best = (rows.mapInArrow(tally, "h long, n long, pos long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
            .withColumn("z", z).where((F.col("n") >= cfg.min_docs) & (F.abs("z") >= cfg.min_z))
            .orderBy(F.abs("z").desc(), "h").limit(cfg.max_features).select("h", "z").collect())
    found = np.array([r["h"] for r in best], np.int64).view(_U)
    order = np.argsort(found)
    features, marked = found[order], (np.array([r["z"] for r in best])[order] > 0) if len(best) else np.zeros(0, bool)

    def reduce(batches):
        for batch in batches:
            at, col, val, words = [], [], [], np.zeros(batch.num_rows)
            for w in slices(batch.column(1), True):
                d, f, k = counts(w, cfg.stems, features)
                at.append(d)
                col.append(f)
                val.append(k)
                words += marked_words(w, cfg.stems, features[marked], batch.num_rows)
            if at:
                yield pa.RecordBatch.from_arrays([pa.array([pack(
                    batch.column(2).to_numpy().astype(np.uint8), words.astype(np.float32), np.concatenate(at).astype(np.int32),
                    np.concatenate(col).astype(np.int32), np.concatenate(val).astype(np.float32))], pa.binary())], ["part"])

    y, hits, row, col, k, docs_so_far = [], [], [], [], [], 0
    for part in rows.mapInArrow(reduce, "part binary").toLocalIterator():     # sample_rows documents in all
        labels_, words, at, f, n = unpack(part["part"])
        y.append(labels_)
        hits.append(words)
        row.append(at + docs_so_far)
        col.append(f)
        k.append(n)
        docs_so_far += len(labels_)
    y, hits, row, col, k = (np.concatenate(x) for x in (y, hits, row, col, k))
    grade = np.where(y > 0, 1 + sum((hits >= g).astype(int) for g in cfg.grade_at), 0)
    grade = np.unique(grade, return_inverse=True)[1]
    w, cuts = fit_ordinal(row, col, np.log1p(k.astype(float)), grade, len(features), cfg)
    return Model(features, w, cuts)


def severity(docs: DataFrame, model: Model, cfg: Toxicity = Toxicity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_features, grade_above (P(grade > k) per threshold), expected_severity, toxic."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            score, hits = np.zeros(n), np.zeros(n, np.int64)
            for w in slices(batch.column(1), True):
                d, f, k = counts(w, cfg.stems, model.features)
                score += np.bincount(d, np.log1p(k) * model.weights[f], n)
                hits += np.bincount(d, minlength=n)
            above = model.above(score)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(hits),
                pa.ListArray.from_arrays(np.arange(0, above.size + 1, above.shape[1], dtype=np.int32), pa.array(above.reshape(-1))),
                pa.array(above.sum(axis=1)), pa.array(model.rejects(above, hits, cfg))],
                [id_col, "n_features", "grade_above", "expected_severity", "toxic"])

    texts = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return texts.mapInArrow(run, f"`{id_col}` long, n_features long, grade_above array<double>, expected_severity double, toxic boolean")


def without_toxic(docs: DataFrame, model: Model, cfg: Toxicity = Toxicity(), text_col: str = "text") -> DataFrame:
    """All columns of the documents that are not rejected; each row is judged by its own text."""
    @F.pandas_udf("boolean")
    def clean(text):
        arr = pa.array(text, pa.string(), from_pandas=True)
        score, hits = np.zeros(len(arr)), np.zeros(len(arr), np.int64)
        for w in slices(arr, True):
            d, f, k = counts(w, cfg.stems, model.features)
            score += np.bincount(d, np.log1p(k) * model.weights[f], len(arr))
            hits += np.bincount(d, minlength=len(arr))
        import pandas as pd
        return pd.Series(~model.rejects(model.above(score), hits, cfg))

    return docs.where(clean(F.col(text_col).cast("string")))
