"""Token counts by a linear longest-match automaton: greedy word-piece lengths without building pieces.

The vocabulary becomes one trie per position (word start, word continuation). Every node knows its
failure link, the node from which matching goes on when no edge fits, and how many pieces are popped on
the way. So each byte of a word is read once and a word's number of pieces is a sum of those counts.
Greedy means: always the longest piece that fits next; a word that cannot be covered counts as one
unknown piece.

A word is a run without ASCII white space, matched as UTF-8 bytes. Each distinct word of a batch is
matched once; all of them advance together, one byte per numpy step.

Defined cases: null or empty texts have no words and no pieces; repeated rows count alike; null ids are
kept; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.words import slices


def byte_characters() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """(word-start, continuation) pieces of a byte-level vocabulary file: with and without the leading space."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    to_byte = byte_characters()
    raw = [bytes(to_byte[c] for c in x) for x in vocabulary if all(c in to_byte for c in x)]
    return [x[1:] for x in raw if x[:1] == b" " and len(x) > 1], [x for x in raw if x and b" " not in x]


@dataclass(frozen=True)
class Automaton:
    """Edges as sorted keys node * 256 + byte; node 0 starts words, node 1 continues them, -1 is nowhere."""

    keys: np.ndarray
    to: np.ndarray
    fail: np.ndarray
    popped: np.ndarray

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node * 256 + byte
        at = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def lengths(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word (byte range); -1 where it cannot be covered."""
        order = np.argsort(start - end, kind="stable")          # longest first: the active words are a prefix
        s, size = start[order], (end - start)[order]
        node, count = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
        for i in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size, -i, side="left"))
            todo = np.arange(active)
            todo = todo[node[:active] >= 0]
            byte = data[s[todo] + i].astype(np.int64)
            while len(todo):
                nxt = self.step(node[todo], byte)
                hit = nxt >= 0
                node[todo[hit]] = nxt[hit]
                todo, byte = todo[~hit], byte[~hit]
                count[todo] += self.popped[node[todo]]
                node[todo] = self.fail[node[todo]]
                alive = node[todo] >= 0
                todo, byte = todo[alive], byte[alive]
        while True:
            left = np.flatnonzero(node > 1)
            if not len(left):
                break
            count[left] += self.popped[node[left]]
            node[left] = self.fail[node[left]]
        out = np.empty(len(s), np.int64)
        out[order] = np.where(node < 0, -1, count)
        return out


def build(starts: list[bytes], continuations: list[bytes]) -> Automaton:
    edges: list[dict[int, int]] = [{}, {}]
    piece, parent, depth = [False, False], [(-1, -1), (-1, -1)], [0, 0]
    for root, words in ((0, starts), (1, continuations)):
        for x in words:
            node = root
            for b in x:
                nxt = edges[node].get(b)
                if nxt is None:
                    nxt = edges[node][b] = len(edges)
                    edges.append({})
                    piece.append(False)
                    parent.append((node, b))
                    depth.append(depth[node] + 1)
                node = nxt
            piece[node] = node > 1
    fail, popped = [-1] * len(edges), [0] * len(edges)
    for v in sorted(range(2, len(edges)), key=depth.__getitem__):
        if piece[v]:
            fail[v], popped[v] = 1, 1
            continue
        u, b = parent[v]
        z, n = fail[u], popped[u]
        while z >= 0 and b not in edges[z]:
            n, z = n + popped[z], fail[z]
        if z >= 0:
            fail[v], popped[v] = edges[z][b], n
    keys = np.array([v * 256 + b for v, e in enumerate(edges) for b in e], np.int64)
    to = np.array([t for e in edges for t in e.values()], np.int64)
    order = np.argsort(keys)
    return Automaton(keys[order], to[order], np.array(fail, np.int64), np.array(popped, np.int64))


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return build(*byte_level_pieces(path))


def piece_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_unknown (words that no pieces cover), n_pieces (unknown words count one)."""
    def run(batches):
        for batch in batches:
            a = automaton(path)
            for w in slices(batch.column(1), False):
                n = w.last - w.first
                _, first, at = np.unique(w.hash, return_index=True, return_inverse=True)
                pieces = a.lengths(w.data, w.start[first], w.end[first])[at]
                doc = w.doc - w.first
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(w.first, n), pa.array(np.bincount(doc, minlength=n)),
                    pa.array(np.bincount(doc[pieces < 0], minlength=n)),
                    pa.array(np.bincount(doc, np.abs(pieces), n).astype(np.int64))], [id_col, "n_words", "n_unknown", "n_pieces"])

    texts = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"`{id_col}` long, n_words long, n_unknown long, n_pieces long")
