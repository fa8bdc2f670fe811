"""Best-fit packing of documents into training sequences under several capacities.

A piece of a document is a vector: tokens, 1 document, and attention cost (its length squared). A
sequence has a capacity for each. Pieces are dealt to groups of about ``group_pieces`` by a hash (any
number of groups fill in parallel, each leaves at most a few open sequences), sorted by size, and each
goes to the open sequence that fits under every constraint and scores best: ``rule`` "norm" leaves the
smallest weighted residual norm, "dot" has the largest weighted dot product of demand and residual.
A new sequence is opened only where none fits.

Only documents longer than ``capacity`` tokens are cut, into full pieces and one rest.

Defined cases: null or empty texts are the end id alone; null document ids are kept; repeated rows are
packed as often as they occur; empty tables give no rows; extra columns are ignored. A piece that no
empty sequence can hold (a cost capacity below its square) raises an error.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.spark import materialise
from kpiloom.llm.tokens import append_end, encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    spaced: bool = False
    end_id: int = 1
    capacity: int = 4096                    # tokens of a sequence
    max_docs: int = 4096                    # documents of a sequence
    max_cost: int = 4096 * 4096             # sum of squared piece lengths
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)     # of tokens, documents and cost, relative to capacity
    rule: str = "norm"
    group_pieces: int = 20_000


def pieces(docs: DataFrame, cfg: Packing, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    run = uuid.uuid4().hex

    def cut(batches):
        for batch in batches:
            enc = encoder(cfg.tokenizer, cfg.spaced, run)
            for first, ids, n in enc.encode(batch.column(1)):
                ids, n = append_end(ids, n, cfg.end_id)
                ids = np.ascontiguousarray(ids.astype("<u4"))
                count = -(-n // cfg.capacity)
                doc = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * cfg.capacity
                length = np.minimum(cfg.capacity, n[doc] - start)
                at = (np.cumsum(n) - n)[doc] + start
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(n)).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(cut, _PIECES)


def best_fit(length: np.ndarray, cfg: Packing) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece."""
    caps = np.array([cfg.capacity, cfg.max_docs, cfg.max_cost], float)
    demand = np.stack([length, np.ones(len(length)), length.astype(float) ** 2], axis=1)
    if len(length) and (demand.max(axis=0) > caps).any():
        raise ValueError("a piece exceeds the capacity of an empty sequence")
    order = np.argsort(-length, kind="stable")
    need, weight = demand / caps, np.array(cfg.weights)
    where, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    left = np.empty((64, 3))               # residuals of the open bins, as shares of the capacities
    names = np.empty(64, np.int64)
    used: list[int] = []
    live, smallest = 0, need.min(axis=0) if len(length) else np.zeros(3)
    eps = 1e-9
    for i in order.tolist():
        d = need[i]
        r = left[:live]
        fits = np.flatnonzero((r >= d - eps).all(axis=1))
        if len(fits):
            rest = r[fits] - d
            score = -(weight * rest * rest).sum(axis=1) if cfg.rule == "norm" else (weight * r[fits] * d).sum(axis=1)
            at = int(fits[np.argmax(score)])
        else:
            if live == len(left):
                left, names = np.concatenate([left, np.empty_like(left)]), np.concatenate([names, np.empty_like(names)])
            at, live = live, live + 1
            left[at], names[at] = 1.0, len(used)
            used.append(0)
        left[at] -= d
        b = int(names[at])
        where[i], offset[i] = b, used[b]
        used[b] += int(length[i])
        if (left[at] < smallest - eps).any():       # full: nothing fits any more
            live -= 1
            left[at], names[at] = left[live], names[live]
    return where, offset


def pack(docs: DataFrame, cfg: Packing, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    found = materialise(pieces(docs, cfg, id_col, text_col), "pieces")
    groups = max(1, -(-found.count() // cfg.group_pieces))

    def fill(key, rows):
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        where, offset = best_fit(rows["length"].to_numpy(), cfg)
        return rows.drop_columns(["group"]).append_column("sequence_id", pa.array((np.int64(key[0].as_py()) << 32) + where)).append_column("offset", pa.array(offset))

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    return found.withColumn("group", group).groupBy("group").applyInArrow(fill, _PIECES + ", sequence_id long, offset long")
