"""Removal of repeated word windows by compacting a word-level De Bruijn graph.

Edges are ``window``-word k-mers of the whole texts; an edge seen before (smaller document id, or the
same document and an earlier start) is a repeat. The graph is partitioned by minimizers: the smallest
hash of the ``seed``-word k-mers inside an edge names its bucket, so consecutive edges mostly share one.

0. Minimizers shared by ``hot_edges`` edges or more (of a phrase that many documents hold, its surroundings
   differing) are counted first, by partial sums. Their edges are dealt out one by one, by the edge's own
   64 bits in the minimizer's place, so no bucket grows with them.
1. Tasks hash whole texts in blocks of words. An edge that already occurred earlier in the block is a
   repeat for certain and is settled there, so a passage that fills a third of all rows leaves each
   block once. First occurrences go to their bucket as runs of consecutive edges.
2. A bucket sorts its edges and links each repeat with the coordinates of its first source. Repeats that
   run on in both the copy and the source are one nonbranching path and become one span.
3. Spans of all buckets meet their document by a join on its id. There, paths cut by bucket borders
   are glued, and spans whose source does not precede them are refused.

Defined cases: null or empty texts have no words; texts shorter than a window repeat nothing; rows
whose id is null are neither sources nor changed; rows with equal id and text are one document;
rows with equal id and other texts are ordered by a hash of their text; extra columns pass through;
texts of any length are read whole, in overlapping blocks; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.blobs import pack, unpack
from kpiloom.llm.words import mix, slices, window_hashes

_U = np.uint64
_SPANS = "id long, version long, start long, windows long, source long, source_version long, source_start long"


@dataclass(frozen=True)
class Repeats:
    window: int = 20            # words per edge
    block_words: int = 1 << 20  # words hashed and compared at once in a task
    bucket_bytes: int = 6 << 20  # text bytes whose edges one bucket receives, on average
    hot_edges: int = 1 << 16    # edges of one minimizer from which they are dealt out one by one

    @property
    def seed(self) -> int:
        return max(1, self.window // 2)


def runs_of(flag_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of the runs that begin where ``flag_start`` is set."""
    first = np.flatnonzero(flag_start)
    return first, np.diff(np.append(first, len(flag_start)))


def _paths(doc, pos, source) -> np.ndarray:
    """Where a new path begins: another document, or copy or source do not run on."""
    new = np.ones(len(doc), bool)
    if len(doc) > 1:
        new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1) | (source[1:] != source[:-1] + 1)
    return new


class _Block:
    """Edges of one block of documents, in ascending (id, version) order."""

    def __init__(self, pieces: list[tuple[int, int, int, np.ndarray]], cfg: Repeats):
        pieces.sort(key=lambda p: p[:3])
        self.ids = np.array([p[0] for p in pieces], np.int64)
        self.versions = np.array([p[1] for p in pieces], np.int64)
        offset = np.array([p[2] for p in pieces], np.int64)
        sizes = np.array([len(p[3]) for p in pieces])
        h = np.concatenate([p[3] for p in pieces])
        edge = window_hashes(h, cfg.window)
        end = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(pieces)), sizes)[:len(edge)]
        at = np.arange(len(edge))
        valid = at + cfg.window <= end[owner]
        small = window_hashes(h, cfg.seed)
        low = small[:len(edge)].copy()
        for k in range(1, cfg.window - cfg.seed + 1):
            np.minimum(low, small[k:k + len(edge)], out=low)
        keep = np.flatnonzero(valid)
        self.owner, self.edge, self.low = owner[keep], edge[keep], low[keep]
        self.pos = keep - (end - sizes)[self.owner] + offset[self.owner]


def _first_of_equals(edge: np.ndarray) -> np.ndarray:
    """For each edge, the index of its first occurrence."""
    order = np.argsort(edge, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = edge[order][1:] == edge[order][:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else order
    return first


def _blocks(batches, cfg: Repeats):
    """Pieces (id, version, first word, hashes) of the texts, ``block_words`` words at a time."""
    pieces, words = [], 0
    for batch in batches:
        ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for w in slices(batch.column(2), False):
            at = w.bounds()
            for k in range(w.last - w.first):
                s, e, name = at[k], at[k + 1], ids[w.first + k]
                if e - s < cfg.window or name is None:
                    continue
                for a in range(s, e - cfg.window + 1, cfg.block_words):
                    part = w.hash[a:min(e, a + cfg.block_words + cfg.window - 1)].copy()
                    pieces.append((name, versions[w.first + k], int(a - s), part))
                    words += len(part)
                    if words >= cfg.block_words:
                        yield pieces
                        pieces, words = [], 0
    if pieces:
        yield pieces


def hot_minimizers(texts: DataFrame, cfg: Repeats, blocks: int) -> np.ndarray:
    """Minimizers of about ``hot_edges`` edges or more, sorted.

    A block reports those with at least half the share that such a minimizer has per block, so one that reaches
    ``hot_edges`` is reported with half of them at least; fewer than 2 / hot_edges of all edges are returned.
    """
    least = max(2, cfg.hot_edges // (2 * max(1, blocks)))

    def count(batches):
        for pieces in _blocks(batches, cfg):
            b = _Block(pieces, cfg)
            first = _first_of_equals(b.edge)
            low, n = np.unique(b.low[first == np.arange(len(first))], return_counts=True)
            top = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(low[top].view(np.int64)), pa.array(n[top].astype(np.int64))], ["low", "n"])

    rows = (texts.mapInArrow(count, "low long, n long").groupBy("low").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= cfg.hot_edges // 2).select("low").collect())
    return np.sort(np.array([r[0] for r in rows], np.int64).view(_U))


def _edges(cfg: Repeats, buckets: int, hot: np.ndarray):
    def emit(pieces):
        b = _Block(pieces, cfg)
        first = _first_of_equals(b.edge)
        moved = (b.ids[b.owner] != b.ids[b.owner[first]]) | (b.versions[b.owner] != b.versions[b.owner[first]]) | (b.pos != b.pos[first])
        dup = np.flatnonzero((first != np.arange(len(first))) & moved)
        start, n = runs_of(_paths(b.owner[dup], b.pos[dup], first[dup]))
        x, y = dup[start], first[dup[start]]
        if len(x):
            yield ("span", (b.ids[b.owner[x]], b.versions[b.owner[x]], b.pos[x], n, b.ids[b.owner[y]], b.versions[b.owner[y]], b.pos[y]))
        own = np.flatnonzero(first == np.arange(len(first)))
        if not len(own):
            return
        owner, pos, low, edge = b.owner[own], b.pos[own], b.low[own], b.edge[own]
        if len(hot):
            low = np.where(hot[np.searchsorted(hot, low).clip(max=len(hot) - 1)] == low, edge, low)
        new = np.ones(len(own), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (pos[1:] != pos[:-1] + 1) | (low[1:] != low[:-1])
        new |= (pos & 63) == 0
        start, n = runs_of(new)
        bucket = ((mix(low[start]) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        start, n, bucket = start[by], n[by], bucket[by]
        width = np.cumsum(n) - n
        at = np.repeat(start - width, n) + np.arange(n.sum())
        tail = edge[at].view(np.uint8).reshape(-1, 8)[:, :5]
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        ends = np.append(width, n.sum())
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            docs, which = np.unique(owner[start[i:j]], return_inverse=True)
            yield ("edge", int(bucket[i]), pack(
                b.ids[docs], b.versions[docs], which.astype(np.uint32), pos[start[i:j]].astype(np.uint64),
                n[i:j].astype(np.uint8), low[start[i:j]]) , tail[ends[i]:ends[j]].tobytes())

    def batches_of(items):
        spans, keys, heads, tails, size = [], [], [], [], 0
        for item in items:
            if item[0] == "span":
                spans.append(item[1])
            else:
                keys.append(item[1])
                heads.append(item[2])
                tails.append(item[3])
                size += len(item[2]) + len(item[3])
            if size > 4 << 20:
                yield record(spans, keys, heads, tails)
                spans, keys, heads, tails, size = [], [], [], [], 0
        if spans or keys:
            yield record(spans, keys, heads, tails)

    def record(spans, keys, heads, tails):
        local = [pack(*[np.asarray(c, np.int64) for c in s]) for s in spans]
        return pa.RecordBatch.from_arrays([
            pa.array([-1] * len(local) + keys, pa.int64()), pa.array(local + heads, pa.binary()),
            pa.array([b""] * len(local) + tails, pa.binary())], ["bucket", "head", "tail"])

    def run(batches):
        yield from batches_of(x for p in _blocks(batches, cfg) for x in emit(p))
    return run


def _repeats(key, rows):
    """Spans of one bucket: every edge that occurs at an earlier coordinate, compacted into paths."""
    spans = [unpack(x) for x, k in zip(rows["head"].to_pylist(), rows["bucket"].to_pylist(), strict=True) if k < 0]
    if spans:
        cols = [np.concatenate(c) for c in zip(*spans, strict=True)]
        return pa.table(dict(zip(_NAMES, cols, strict=True)))
    ids, versions, pos, n, low, edge, at, base = [], [], [], [], [], [], [], 0
    for head, tail in zip(rows["head"].to_pylist(), rows["tail"].to_pylist(), strict=True):
        i, v, which, p, k, m = unpack(head)
        k = k.astype(np.int64)
        ids.append(i[which])
        versions.append(v[which])
        pos.append(p.astype(np.int64))
        n.append(k)
        low.append(m)
        raw = np.zeros((len(tail) // 5, 8), np.uint8)
        raw[:, :5] = np.frombuffer(tail, np.uint8).reshape(-1, 5)
        edge.append(raw.view(_U).reshape(-1))
        at.append(base + np.cumsum(k) - k)
        base += int(k.sum())
    ids, versions, pos, n, low, edge, at = map(np.concatenate, (ids, versions, pos, n, low, edge, at))
    order = np.lexsort((pos, versions, ids))
    ids, versions, pos, n, low, at = (x[order] for x in (ids, versions, pos, n, low, at))
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    value = edge[np.repeat(at, n) + inner] ^ mix(np.repeat(low, n))
    run = np.repeat(np.arange(len(n)), n)
    place = pos[run] + inner
    by = np.argsort(value, kind="stable")
    same = np.zeros(len(by), bool)
    same[1:] = value[by][1:] == value[by][:-1]
    dup_sorted = np.flatnonzero(same)
    lead = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))[dup_sorted]]
    dup = by[dup_sorted]
    back = np.argsort(dup, kind="stable")
    dup, lead = dup[back], lead[back]
    moved = (ids[run[dup]] != ids[run[lead]]) | (versions[run[dup]] != versions[run[lead]]) | (place[dup] != place[lead])
    dup, lead = dup[moved], lead[moved]
    begins = np.ones(len(dup), bool)
    if len(dup) > 1:
        r, s = run[dup], run[lead]
        begins[1:] = ((ids[r[1:]] != ids[r[:-1]]) | (versions[r[1:]] != versions[r[:-1]]) | (place[dup[1:]] != place[dup[:-1]] + 1)
                      | (ids[s[1:]] != ids[s[:-1]]) | (versions[s[1:]] != versions[s[:-1]]) | (place[lead[1:]] != place[lead[:-1]] + 1))
    start, k = runs_of(begins)
    x, y = dup[start], lead[start]
    return pa.table(dict(zip(_NAMES, (ids[run[x]], versions[run[x]], place[x], k, ids[run[y]], versions[run[y]], place[y]), strict=True)))


_NAMES = ("id", "version", "start", "windows", "source", "source_version", "source_start")


def _version(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(docs: DataFrame, cfg: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paths of repeated windows: id, version, start, windows and the coordinates of their source."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // cfg.bucket_bytes))
    texts = texts.select("id", _version(F.col("text")).alias("version"), "text")
    # A word and its space take some 6 bytes: blocks of whole texts, estimated.
    small = replace(cfg, block_words=max(cfg.window, cfg.block_words // 8))       # counting takes an eighth of the memory
    hot = hot_minimizers(texts, small, -(-total // (6 * small.block_words)))
    edges = texts.mapInArrow(_edges(cfg, buckets, hot), "bucket long, head binary, tail binary")
    # Local spans (bucket -1) are dealt out over groups of their own.
    deal = F.when(F.col("bucket") >= 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("head"), F.lit(buckets)))
    spans = edges.withColumn("deal", deal).groupBy("bucket", "deal").applyInArrow(_repeats, _SPANS)
    earlier = F.struct("source", "source_version", "source_start") < F.struct("id", "version", "start")
    return spans.where(earlier)


def glue(starts: list[int], windows: list[int], size: int) -> list[tuple[int, int]]:
    """Word ranges [from, to) covered by the windows, merged."""
    out: list[list[int]] = []
    for s, n in sorted(zip(starts, windows, strict=True)):
        e = s + n - 1 + size
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def with_spans(docs: DataFrame, cfg: Repeats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with their spans as array ``spans_`` (null: none)."""
    found = (repeated_spans(docs, cfg, id_col, text_col).groupBy(F.col("id").alias("span_id_"), F.col("version").alias("span_version_"))
             .agg(F.collect_list(F.struct("start", "windows")).alias("spans_")))
    mine = docs.withColumn("id_", F.col(id_col).cast("long")).withColumn("version_", _version(F.col(text_col).cast("string")))
    fits = (F.col("id_") == F.col("span_id_")) & (F.col("version_") == F.col("span_version_"))
    return mine.join(found, fits, "left").drop("span_id_", "span_version_", "id_", "version_")


def kept_words(docs: DataFrame, cfg: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_removed, kept_sha256 of the kept words joined by single spaces."""
    def run(batches):
        for batch in batches:
            n_words, n_removed, sha = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                kept = words
                if spans.is_valid:
                    kept, last = [], 0
                    found = spans.as_py()
                    for s, e in glue([x["start"] for x in found], [x["windows"] for x in found], cfg.window):
                        kept += words[last:s]
                        last = e
                    kept += words[last:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(sha)], [id_col, "n_words", "n_removed", "kept_sha256"])

    joined = with_spans(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)), cfg, id_col, text_col)
    return joined.select(id_col, text_col, "spans_").mapInArrow(run, f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string")


def cut_text(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without the words of the ranges, other white space unchanged."""
    raw = text.encode()
    for w in slices(pa.array([text]), False):
        out, last = [], 0
        for s, e in ranges:
            out.append(raw[last:w.start[s]])
            last = int(w.end[e - 1])
        out.append(raw[last:])
        return b" ".join(x.strip() for x in out if x.strip()).decode()
    return text


def remove_repeats(docs: DataFrame, cfg: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns and rows of ``docs``, with repeated windows cut out of the text."""
    @F.pandas_udf("string")
    def cut(text, spans):
        return text.combine(spans, lambda t, x: t if t is None or x is None or not len(x) else
                            cut_text(t, glue([y["start"] for y in x], [y["windows"] for y in x], cfg.window)))

    joined = with_spans(docs, cfg, id_col, text_col)
    changed = F.when(F.col("spans_").isNull(), F.col(text_col)).otherwise(cut(F.col(text_col), F.col("spans_")))
    return joined.withColumn(text_col, changed).select(*docs.columns)
