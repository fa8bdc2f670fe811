"""Benchmark decontamination by latent semantic retrieval, then alignment.

1. Documents are read as passages of ``window`` words, half overlapping; benchmark items as passages of
   at most as many words; a rest of under ``min_words`` words is read with what precedes it. Features are the benchmark's words; their document frequencies are counted
   over all passages of all documents. Words in more than ``max_share`` of them are left out, but every
   benchmark passage keeps its ``keep_rarest`` rarest words.
2. A randomised SVD of the TF-IDF matrix A of all passages: one distributed pass sums A'(A Omega) for a
   random Omega, task sums are added up in Spark in two levels, and the Nystrom form of A'A gives the
   ``rank`` leading directions. Benchmark rows enter with as much energy as all documents together.
3. Every document passage is projected; a cosine of ``min_cosine`` or more with a benchmark passage makes
   a candidate.
4. A candidate is confirmed if the longest common subsequence of words with the text around it covers
   ``min_overlap`` of the benchmark passage and, where the passage ends its item, ``answer_overlap`` of the
   item's last ``answer_words`` words (its answer). So changed, dropped or inserted words do not hide a copy. Benchmark passages under
   ``min_words`` words must occur word for word.
5. Passages that occur word for word are found without the latent space too: the hash of a passage's
   first words (``min_words`` at most) is looked up at every word of every document, then all its words.

The benchmark is taken in blocks of at most ``block_words`` words, so what is broadcast is bounded by
parameters; each block costs three passes over the documents.

Defined cases: null or empty texts match nothing, and empty items are ignored; items with a null id are
ignored; repeated items match alike; rows that repeat a document are judged alike; null document ids
are kept; texts of any length are read whole; extra columns pass through; empty tables give no matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.blobs import pack, unpack
from kpiloom.llm.words import Words, slices, window_hashes

_LOW = np.uint64(0xFFFF)


@dataclass(frozen=True)
class Latent:
    window: int = 64
    rank: int = 224
    extra: int = 32             # random directions beyond the rank
    max_share: float = 0.02
    keep_rarest: int = 6
    min_cosine: float = 0.45
    min_overlap: float = 0.75
    answer_words: int = 5
    answer_overlap: float = 0.6
    min_words: int = 8
    block_words: int = 200_000
    seed: int = 7

    @property
    def stride(self) -> int:
        return self.window // 2


@dataclass(frozen=True)
class Index:
    """One block of the benchmark: passages as word hashes, and the latent space."""

    items: tuple[int, ...]              # item of each passage
    passages: tuple[np.ndarray, ...]
    ends: tuple[bool, ...]              # whether the passage ends its item
    vocabulary: np.ndarray              # sorted word hashes; a column each
    idf: np.ndarray                     # 0: left out
    space: np.ndarray                   # columns x rank
    latent: np.ndarray                  # passages x rank, unit length
    heads: tuple[tuple[int, np.ndarray, np.ndarray], ...]      # words, sorted hashes of so many first words, their passages


def passages_of(w: Words, vocabulary: np.ndarray, cfg: Latent) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, then distinct entries: passage, column, count) of a slice's passages."""
    at = w.bounds()
    n = np.diff(at)
    many = np.maximum(np.where(n > 0, -(-(n - cfg.stride) // cfg.stride), 0), (n > 0).astype(np.int64))
    base = np.cumsum(many) - many
    doc = np.repeat(np.arange(len(n)), many)
    first = (np.arange(len(doc)) - base[doc]) * cfg.stride + at[:-1][doc] if len(doc) else np.zeros(0, np.int64)
    if not len(vocabulary) or not len(w.hash):
        none = np.zeros(0, np.int64)
        return doc, first, none, none, none
    col = np.searchsorted(vocabulary, w.hash).clip(max=len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[col] == w.hash)
    d = w.doc[hit] - w.first
    step = (hit - at[d]) // cfg.stride
    cols = col[hit]
    late, early = step < many[d], step > 0
    row = np.concatenate([(base[d] + step)[late], (base[d] + step - 1)[early]])
    key, count = np.unique(row * len(vocabulary) + np.concatenate([cols[late], cols[early]]), return_counts=True)
    return doc, first, key // len(vocabulary), key % len(vocabulary), count


def weighted(row: np.ndarray, col: np.ndarray, count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keep = idf[col] > 0
    return row[keep], col[keep], ((1 + np.log(count[keep])) * idf[col[keep]]).astype(np.float32)


def segment_sums(first: np.ndarray, index: np.ndarray, value: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Sums of ``source[index] * value`` over the segments that begin at ``first``, a few hundred at a time."""
    n = np.diff(np.append(first, len(index)))
    out = np.zeros((len(first), source.shape[1]), source.dtype)
    order = np.argsort(-n, kind="stable")
    for a in range(0, len(order), 256):
        some = order[a:a + 256]
        sums, at, size = np.zeros((len(some), source.shape[1]), source.dtype), first[some], n[some]
        for j in range(int(size[0])):
            m = int(np.searchsorted(-size, -j, "left"))         # segments with more than j entries lead
            entry = at[:m] + j
            part = source[index[entry]]
            part *= value[entry][:, None]
            sums[:m] += part
        out[some] = sums
    return out


def project(row: np.ndarray, col: np.ndarray, value: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have entries, their products with ``space``); rows must be ascending."""
    if not len(row):
        return row, np.zeros((0, space.shape[1]), np.float32)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    return row[first], segment_sums(first, col, value, space)


def project_back(row: np.ndarray, col: np.ndarray, value: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns that have entries, their products with the rows ``z``); rows are numbered from 0."""
    by = np.argsort(col, kind="stable")
    first = np.flatnonzero(np.append(True, col[by][1:] != col[by][:-1]))
    return col[by][first], segment_sums(first, row[by], value[by], z)


def common_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``a`` are in one longest common subsequence with ``b`` (bit-parallel)."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full, row, rows = (1 << len(a)) - 1, (1 << len(a)) - 1, []
    b = [x for x in b.tolist() if x in masks]
    for x in b:
        u = row & masks[x]
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    out = np.zeros(len(a), bool)
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:                    # a zero bit i marks a step of the table's row
        if rows[j] >> i & 1:
            i -= 1
        elif j > 0 and not rows[j - 1] >> i & 1:
            j -= 1
        else:
            out[i] = True
            i, j = i - 1, j - 1
    return out


def overlap(passage: np.ndarray, around: np.ndarray, cfg: Latent, ends: bool = True) -> float:
    """Share of the passage found in order around a candidate; 0 if that, or of its answer, is too little."""
    if len(passage) < cfg.min_words:
        n = len(passage)
        return float(any(np.array_equal(around[i:i + n], passage) for i in np.flatnonzero(around == passage[0])))
    there = set(around.tolist())
    if sum(x in there for x in passage.tolist()) < cfg.min_overlap * len(passage):
        return 0.0
    found = common_words(passage, around)
    good = found.mean() >= cfg.min_overlap and (not ends or found[-cfg.answer_words:].mean() >= cfg.answer_overlap)
    return float(found.mean()) if good else 0.0


def heads_of(passages: list[np.ndarray], cfg: Latent) -> tuple[tuple[int, np.ndarray, np.ndarray], ...]:
    size = np.array([min(len(p), cfg.min_words) for p in passages])
    out = []
    for n in np.unique(size[size > 0]).tolist():
        which = np.flatnonzero(size == n)
        h = np.array([window_hashes(passages[i][:n], n)[0] for i in which], np.uint64)
        order = np.argsort(h, kind="stable")
        out.append((n, h[order], which[order]))
    return tuple(out)


def verbatim(w: Words, index: Index) -> Iterator[tuple[int, int]]:
    """(document, benchmark passage) of the passages that occur word for word in a slice, each once."""
    end, seen = w.bounds()[1:], set()
    for n, hashes, numbers in index.heads:
        g = window_hashes(w.hash, n)
        marked = np.zeros(1 << 16, bool)
        marked[(hashes & _LOW).astype(np.int64)] = True
        at = np.flatnonzero(marked[(g & _LOW).astype(np.int64)])       # few others have the same last bits
        lo, hi = np.searchsorted(hashes, g[at], "left"), np.searchsorted(hashes, g[at], "right")
        at, lo, many = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        place = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        at = np.repeat(at, many)
        for i, d, p in zip(at.tolist(), w.doc[at].tolist(), numbers[place].tolist(), strict=True):
            words = index.passages[p]
            if (d, p) not in seen and i + len(words) <= end[d - w.first] and np.array_equal(w.hash[i:i + len(words)], words):
                seen.add((d, p))
                yield d, p


def matches(column: pa.Array, index: Index, cfg: Latent) -> Iterator[tuple[int, int, float]]:
    """(document in the column, benchmark passage, share of it) of confirmed candidates."""
    for w in slices(column, True):
        for d, p in verbatim(w, index):
            yield d, p, 1.0
        doc, first, row, col, count = passages_of(w, index.vocabulary, cfg)
        row, col, value = weighted(row, col, count, index.idf)
        rows, z = project(row, col, value, index.space)
        if not len(rows):
            continue
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        at = w.bounds()
        cosine = z @ index.latent.T
        for r, p in zip(*np.nonzero(cosine >= cfg.min_cosine), strict=True):
            d = doc[rows[r]]
            a = max(at[d], first[rows[r]] - cfg.stride)
            share = overlap(index.passages[p], w.hash[a:min(at[d + 1], first[rows[r]] + cfg.window + cfg.stride)], cfg, index.ends[p])
            if share:
                yield int(d + w.first), int(p), share


def _benchmark_blocks(benchmark: DataFrame, cfg: Latent, id_col: str, text_col: str) -> Iterator[tuple[list[int], list[np.ndarray], list[bool]]]:
    """Items, words and ends (whether it is its item's last) of passages, a block of them at a time."""
    rows = (benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .where("id is not null").groupBy("id", "text").agg(F.lit(1)).toLocalIterator())
    items, passages, ends, words = [], [], [], 0
    for r in rows:
        for w in slices(pa.array([r["text"]], pa.string()), True):
            for i in range(0, len(w.hash), cfg.window):
                part = w.hash[i:i + cfg.window]
                if i and len(part) < cfg.min_words:
                    part = w.hash[-cfg.window:]
                items.append(r["id"])
                passages.append(part.copy())
                ends.append(i + cfg.window >= len(w.hash))
                words += len(part)
        if words >= cfg.block_words:
            yield items, passages, ends
            items, passages, ends, words = [], [], [], 0
    if items:
        yield items, passages, ends


def build_index(texts: DataFrame, items: list[int], passages: list[np.ndarray], ends: list[bool], cfg: Latent) -> Index:
    """The latent space of one block over all passages of ``texts(text)``."""
    vocabulary = np.unique(np.concatenate(passages))
    size = cfg.rank + cfg.extra

    def frequencies(batches):
        df, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for w in slices(batch.column(0), True):
                doc, _, _, col, _ = passages_of(w, vocabulary, cfg)
                df += np.bincount(col, minlength=len(vocabulary))
                n += len(doc)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(df))), pa.array(np.append(n, df))], ["c", "n"])

    counted = texts.mapInArrow(frequencies, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).toPandas()   # the block's words
    df = np.zeros(len(vocabulary) + 1)
    df[counted["c"].to_numpy() + 1] = counted["n"].to_numpy()
    total, df = max(1.0, df[0]), df[1:]
    idf = np.log1p(total / (df + 1))
    kept = df <= cfg.max_share * total
    own = [np.searchsorted(vocabulary, np.unique(p)) for p in passages]
    for cols in own:
        kept[cols[np.argsort(df[cols], kind="stable")[:cfg.keep_rarest]]] = True
    idf = np.where(kept, idf, 0.0)
    omega = np.random.default_rng(cfg.seed).standard_normal((len(vocabulary), size)).astype(np.float32)

    def products(batches):
        from pyspark import TaskContext

        total = np.zeros((len(vocabulary), size))
        energy = 0.0
        for batch in batches:
            for w in slices(batch.column(0), True):
                row, col, value = weighted(*passages_of(w, vocabulary, cfg)[2:], idf)
                if not len(row):
                    continue
                energy += float((value.astype(float) ** 2).sum())
                rows, z = project(row, col, value, omega)
                cols, sums = project_back(np.searchsorted(rows, row), col, value, z)
                total[cols] += sums
        parts = np.array_split(np.arange(len(vocabulary)), 16)
        task = TaskContext.get().partitionId() % 256
        for i, p in enumerate(parts):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([task], pa.int64()),
                                              pa.array([pack(total[p].reshape(-1), np.array([energy]))], pa.binary())], ["part", "task", "sums"])

    def add(key, rows):
        cols = [np.sum(x, axis=0) for x in zip(*(unpack(b) for b in rows["sums"].to_pylist()), strict=True)]
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "task": pa.array([0], pa.int64()),
                         "sums": pa.array([pack(*cols)], pa.binary())})

    shape = "part long, task long, sums binary"
    summed = (texts.mapInArrow(products, shape).groupBy("part", "task").applyInArrow(add, shape)
              .groupBy("part").applyInArrow(add, shape).collect())             # 16 rows, columns x size numbers in all
    g, energy = np.zeros((len(vocabulary), size)), 0.0
    for r in summed:
        sums, e = unpack(r["sums"])
        g[np.array_split(np.arange(len(vocabulary)), 16)[r["part"]]] = sums.reshape(-1, size)
        energy = float(e[0])
    counted = [np.unique(np.searchsorted(vocabulary, p), return_counts=True) for p in passages]
    row = np.repeat(np.arange(len(passages)), [len(c) for c, _ in counted])
    row, col, value = weighted(row, *(np.concatenate(x) for x in zip(*counted, strict=True)), idf)
    own_energy = float((value.astype(float) ** 2).sum()) or 1.0
    rows, z = project(row, col, value, omega)
    cols, sums = project_back(np.searchsorted(rows, row), col, value, z)
    g[cols] += max(energy, own_energy) / own_energy * sums
    space = leading_directions(g, omega.astype(float), cfg.rank).astype(np.float32)
    latent = np.zeros((len(passages), cfg.rank), np.float32)
    rows, z = project(row, col, value, space)
    latent[rows] = z
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return Index(tuple(items), tuple(passages), tuple(ends), vocabulary, idf, space, latent, heads_of(passages, cfg))


def leading_directions(g: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal leading eigenvectors of the Nystrom form g (omega' g)^+ g' of A'A, from g = A'A omega."""
    core = omega.T @ g
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > value.max(initial=0) * 1e-10
    if not good.any():
        return np.zeros((len(g), rank))
    half = g @ (vector[:, good] / np.sqrt(value[good]))
    u, _, _ = np.linalg.svd(half, full_matrices=False)
    out = np.zeros((len(g), rank))
    out[:, :min(rank, u.shape[1])] = u[:, :rank]
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, cfg: Latent = Latent(), id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs of a document id and a benchmark item it holds: ids, overlap (largest share), n_passages."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], "id long, item long, passage long, share double")
    for items, passages, ends in _benchmark_blocks(benchmark, cfg, item_col, item_text_col):
        index = build_index(texts.select("text"), items, passages, ends, cfg)

        def run(batches, index=index):
            for batch in batches:
                got = list(matches(batch.column(1), index, cfg))
                if got:
                    d, p, share = zip(*got, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d)), pa.array([index.items[i] for i in p], pa.int64()),
                                                      pa.array(p, pa.int64()), pa.array(share)], ["id", "item", "passage", "share"])

        found = found.union(texts.mapInArrow(run, "id long, item long, passage long, share double"))
    return (found.groupBy("id", "item").agg(F.max("share").alias("overlap"), F.countDistinct("passage").alias("n_passages"))
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "overlap", "n_passages"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, cfg: Latent = Latent(), text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, all columns, that hold no benchmark item; each row is judged by its own text."""
    kept = docs
    for items, passages, ends in _benchmark_blocks(benchmark, cfg, item_col, item_text_col):
        index = build_index(docs.select(F.col(text_col).cast("string").alias("text")), items, passages, ends, cfg)

        @F.pandas_udf("boolean")
        def clean(text: pd.Series) -> pd.Series:
            out = np.ones(len(text), bool)
            for d, _, _ in matches(pa.array(text, pa.string(), from_pandas=True), index, cfg):
                out[d] = False
            return pd.Series(out)

        kept = kept.where(clean(F.col(text_col).cast("string")))
    return kept
