"""Exact top-k by inner product with pivot-table elimination.

Vectors are whole numbers (``floor(scale * x)``), so scores are exact. Every vector carries its distance
to each of ``pivots`` fixed vectors (chosen once, by the smallest hashes of their ids). The triangle
inequality over all pivots gives the largest lower bound of a distance and so an upper bound of the
inner product: (|q|^2 + |x|^2 - bound^2) / 2. Candidates are evaluated in the order of their bounds, and
a query stops when the next bound cannot reach its k-th best score: exact, ties included.

Pivots of the dimensions with most vectors are sent to the tasks, ``pivot_bytes`` in all; vectors of other
dimensions are bounded by their lengths alone, as exactly. There is no limit on the number of dimensions.

Candidates travel in blocks, queries in blocks of ``query_block``; each candidate block meets each query
block by an equality join, and a task keeps a query block's running best over all blocks it sees.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part; a
vector is compared with those of its own dimension; rows whose id is null take no part; equal vectors
tie and go by id; a query's own id is no candidate; rows that repeat an id are all candidates and the
query is answered once per id (by its smallest vector); extra columns are ignored; vectors of any length take part
whole; empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.spark import materialise

_BLOCK = "dim int, ids binary, vectors binary, distances binary"


@dataclass(frozen=True)
class TopK:
    k: int = 5
    scale: int = 256
    pivots: int = 48
    pivot_bytes: int = 32 << 20  # of pivots sent to the tasks
    query_block: int = 128
    block: int = 1024           # vectors of a candidate block
    held_bytes: int = 64 << 20  # of vectors a task holds before it sends its unfilled blocks
    chunk: int = 64             # candidates evaluated between two looks at the stopping rule


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component as array<long>; null if the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fit = F.coalesce((F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))
    return F.when(fit, F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")))


def _blocks(cfg: TopK, pivots: dict[int, np.ndarray]):
    def run(batches):
        held: dict[int, list] = {}
        size = 0

        def flush(dim, rows):
            ids = np.array([r[0] for r in rows], np.int64)
            m = np.stack([r[1] for r in rows])
            d = distances(m, pivots.get(dim, np.zeros((0, dim))))
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, m, d))],
                                              ["dim", "ids", "vectors", "distances"])

        for batch in batches:
            col = batch.column(1)
            off = np.asarray(col.offsets)
            flat = np.asarray(col.values, np.int64)
            for i, name in enumerate(batch.column(0).to_pylist()):
                v = flat[off[i]:off[i + 1]]
                rows = held.setdefault(len(v), [])
                rows.append((name, v.copy()))
                size += 8 * len(v)
                if len(rows) >= cfg.block:
                    yield flush(len(v), held.pop(len(v)))
                    size -= 8 * len(v) * cfg.block
                elif size >= cfg.held_bytes:
                    yield from (flush(dim, rows) for dim, rows in held.items())
                    held, size = {}, 0
        for dim, rows in held.items():
            if rows:
                yield flush(dim, rows)
    return run


def distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = m.astype(float), pivots.astype(float)
    square = (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(square, 0)).astype(np.float32)


class _Best:
    """Running best k of each query of a block."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, d: np.ndarray, cfg: TopK):
        self.ids, self.m, self.d, self.cfg = ids, m, d, cfg
        self.norm = (m.astype(float) ** 2).sum(axis=1)
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)

    def offer(self, ids: np.ndarray, m: np.ndarray, d: np.ndarray) -> None:
        k, step = self.cfg.k, self.cfg.chunk
        norm = (m.astype(float) ** 2).sum(axis=1)
        exact = m.astype(float) if max(self.norm.max(initial=0), norm.max(initial=0)) < 2**52 else m
        low = np.zeros((len(self.ids), len(ids)), np.float32)
        gap = np.empty_like(low)
        for p in range(d.shape[1]):
            np.subtract(self.d[:, p, None], d[None, :, p], out=gap)
            np.abs(gap, out=gap)
            np.maximum(low, gap, out=low)
        slack = 1e-5 * (self.d.max(axis=1, initial=0)[:, None] + d.max(axis=1, initial=0)[None, :]) + 1e-3
        low = np.maximum(low - slack, 0)
        bound = (self.norm[:, None] + norm[None, :] - low.astype(float) ** 2) / 2 + 1
        for i, own in enumerate(self.ids):
            best_id, best = self.found[i]
            least = best[-1] if len(best) >= k else None
            todo = np.arange(len(ids)) if least is None else np.flatnonzero(bound[i] >= least)
            todo = todo[ids[todo] != own]
            todo = todo[np.argsort(-bound[i][todo], kind="stable")]
            for a in range(0, len(todo), step):
                part = todo[a:a + step]
                if len(best) >= k and bound[i][part[0]] < best[-1]:
                    break
                score = (exact[part] @ self.m[i].astype(exact.dtype)).astype(np.int64)
                best_id, best = np.append(best_id, ids[part]), np.append(best, score)
                order = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[order], best[order]
            self.found[i] = best_id, best


def _search(cfg: TopK):
    def matrix(row, dim, at):
        ids = np.frombuffer(row[at], np.int64)
        return ids, np.frombuffer(row[at + 1], np.int64).reshape(len(ids), dim), np.frombuffer(row[at + 2], np.float32).reshape(len(ids), -1)

    def run(batches):
        open_blocks: dict[int, _Best] = {}
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)), strict=True):
                number, dim = row[0], row[1]
                if number not in open_blocks:
                    open_blocks[number] = _Best(*matrix(row, dim, 2), cfg)
                open_blocks[number].offer(*matrix(row, dim, 5))
        for b in open_blocks.values():
            n = [len(x) for x, _ in b.found]
            if sum(n):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(b.ids, n)), pa.array(np.concatenate([x for x, _ in b.found])),
                    pa.array(np.concatenate([s for _, s in b.found]))], ["query_id", "vec_id", "score"])
    return run


def pivot_table(rows: DataFrame, cfg: TopK) -> dict[int, np.ndarray]:
    """Pivots by dimension, the rows of smallest id hash: of the dimensions with most rows, within ``pivot_bytes``."""
    size = F.col("dim").cast("long") * (8 * cfg.pivots)
    most = rows.groupBy("dim").agg(F.count("*").alias("n")).where(size <= cfg.pivot_bytes)
    most = most.orderBy(F.desc("n"), "dim").limit(1000).collect()
    dims, left = [], cfg.pivot_bytes
    for r in most:
        left -= 8 * cfg.pivots * r["dim"]
        if left < 0:
            break
        dims.append(r["dim"])
    order = Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id", "v")
    few = rows.where(F.col("dim").isin(dims)).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= cfg.pivots)
    found: dict[int, list] = {}
    for r in few.select("dim", "v").collect():          # pivot_bytes at most
        found.setdefault(r["dim"], []).append(r["v"])
    return {dim: np.array(v, np.int64) for dim, v in found.items()}


def top_k(vectors: DataFrame, is_query: Column, cfg: TopK = TopK(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: every query's best ``k`` rows of all others, exactly."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"), whole_numbers(F.col(vector_col), cfg.scale).alias("v"))
            .where("id is not null and v is not null"))
    rows = materialise(rows.withColumn("dim", F.size("v")), "vectors")
    pivots = pivot_table(rows, cfg)
    candidates = rows.select("id", "v").mapInArrow(_blocks(cfg, pivots), _BLOCK)
    asked = rows.where("asks").groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    counts = materialise(asked, "queries")
    total = counts.count()
    parts = max(1, -(-total // cfg.query_block))

    def collect_block(key, table):
        ids = table["id"].to_numpy()
        m = np.array(table["v"].to_pylist(), np.int64).reshape(len(ids), -1)
        d = distances(m, pivots.get(m.shape[1], np.zeros((0, m.shape[1]))))
        return pa.table({"number": pa.array([key[0].as_py()], pa.int64()), "dim": pa.array([m.shape[1]], pa.int32()),
                         **{c: pa.array([x.tobytes()], pa.binary()) for c, x in (("ids", ids), ("vectors", m), ("distances", d))}})

    number = F.col("dim").cast("long") * parts + F.pmod(F.xxhash64("id"), F.lit(parts))
    queries = materialise(counts.withColumn("number", number).groupBy("number").applyInArrow(collect_block, "number long, " + _BLOCK), "query-blocks")
    meets = candidates.withColumn("number", F.explode(F.sequence(F.col("dim").cast("long") * parts, F.col("dim").cast("long") * parts + parts - 1)))
    left = queries.select("number", "dim", *[F.col(c).alias("q_" + c) for c in ("ids", "vectors", "distances")])
    pairs = left.join(meets.drop("dim"), "number").select("number", "dim", "q_ids", "q_vectors", "q_distances", "ids", "vectors", "distances")
    found = pairs.mapInArrow(_search(cfg), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cfg.k).select("query_id", "rank", "vec_id", "score")
