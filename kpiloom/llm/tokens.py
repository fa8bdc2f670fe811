"""Token ids of whole texts by a public tokenizer, each distinct chunk of text encoded once per worker.

Both vocabularies split texts before merging, and never across the borders used here:

* ``spaced`` (byte-level, white space kept): a chunk is a run without ASCII white space together with one
  space before it; the white space left over forms chunks of its own.
* ``words`` (white space dropped, lower-cased): a chunk is a run without ASCII white space.

So the ids of a text are the ids of its chunks in order. Texts with other white space, or with the
strings of special tokens, are encoded whole instead. A worker remembers up to ``REMEMBERED`` chunks
during one run; beyond that it starts anew, which costs time only.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kpiloom.llm.words import Words, range_hashes, slices

REMEMBERED = 2_000_000
GROUP = 64
_ODD = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|<\|")
_ODD_MARKS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80", b"<|")
_WORKER: dict = {}


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True      # their strings in a text are ordinary text
    return t


def chunks(w: Words, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the chunks of a slice, in order."""
    if not spaced:
        return w.start, w.end, w.doc
    at = w.bounds()
    n = len(w.data)
    s, e = w.start, w.end
    text_start, text_end = w.text_start, w.text_end
    before = np.where(np.arange(len(s)) > 0, np.append(0, e[:-1]), 0) if len(s) else s
    first = np.zeros(len(s), bool)
    first[at[:-1][at[:-1] < at[1:]]] = True
    before = np.where(first, text_start[w.doc - w.first], before)
    led = (s > before) & (w.data[np.maximum(s - 1, 0)] == 32) if n else np.zeros(0, bool)
    word_from = s - led
    gap = word_from - before                        # white space that is not the word's own space
    one = (gap > 0) & ~led                          # its last character stands alone
    whole_to = np.where(one, word_from - 1, word_from)
    whole = whole_to > before
    last = np.flatnonzero(at[1:] > at[:-1])
    tail_from = text_start.copy()
    tail_from[last] = e[at[1:][last] - 1]
    tail = tail_from < text_end
    start = np.concatenate([word_from, before[whole], word_from[one] - 1, tail_from[tail]])
    end = np.concatenate([e, whole_to[whole], word_from[one], text_end[tail]])
    doc = np.concatenate([w.doc, w.doc[whole], w.doc[one], np.flatnonzero(tail) + w.first])
    order = np.argsort(start, kind="stable")
    return start[order], end[order], doc[order]


class Encoder:
    """Ids of chunks, remembered by hash."""

    def __init__(self, path: str, spaced: bool):
        self.t, self.spaced = tokenizer(path), spaced
        vocabulary = self.t.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.leads = np.zeros(self.size, bool)
        self.leads[[i for x, i in vocabulary.items() if x.startswith("Ġ")]] = True
        self.mark = vocabulary.get("|</w>", -1)
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of distinct chunks; most are encoded in groups and cut apart again."""
        out: list = [None] * len(texts)
        if self.spaced:
            easy = [i for i, x in enumerate(texts) if x[0] == " " and len(x) > 1 and not x[1:2].isspace()]
        else:
            easy = [i for i, x in enumerate(texts) if "|" not in x]
        groups = [easy[i:i + GROUP] for i in range(0, len(easy), GROUP)]
        joined = ["".join(texts[i] for i in g) if self.spaced else " | ".join(texts[i] for i in g) for g in groups]
        for g, ids in zip(groups, self._plain(joined), strict=True):
            if self.spaced:
                cut = np.append(np.flatnonzero(self.leads[ids]), len(ids))
                if len(cut) == len(g) + 1 and cut[0] == 0:
                    for i, a, b in zip(g, cut[:-1], cut[1:], strict=True):
                        out[i] = ids[a:b]
            else:
                cut = np.concatenate([[-1], np.flatnonzero(ids == self.mark), [len(ids)]])
                if len(cut) == len(g) + 1:
                    for i, a, b in zip(g, cut[:-1], cut[1:], strict=True):
                        out[i] = ids[a + 1:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._plain([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def learn(self, u: np.ndarray, first: np.ndarray, start: np.ndarray, end: np.ndarray, raw: bytes) -> np.ndarray:
        """Indices of distinct hashes in what is remembered; unknown chunks (at ``first``) are encoded first."""
        if len(self.keys) + len(u) > REMEMBERED and len(self.keys):
            self.clear()
        at = np.searchsorted(self.keys, u)
        known = np.zeros(len(u), bool)
        if len(self.keys):
            known = self.keys[at.clip(max=len(self.keys) - 1)] == u
        new = first[~known]
        if len(new):
            ids = self._encode([raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            n = np.array([len(x) for x in ids])
            where = at[~known]                  # both sides are sorted
            self.keys = np.insert(self.keys, where, u[~known])
            self.at = np.insert(self.at, where, len(self.ids) + np.cumsum(n) - n)
            self.n = np.insert(self.n, where, n)
            self.ids = np.concatenate([self.ids, *ids])
            at = np.searchsorted(self.keys, u)
        return at

    def _slices(self, column: pa.Array):
        """(words, raw bytes, chunk bounds and documents, ids of texts that must be encoded whole)."""
        for w in slices(column, False, 1 << 20):
            start, end, doc = chunks(w, self.spaced)
            raw, odd = w.data.tobytes(), {}
            if any(x in raw for x in _ODD_MARKS) and _ODD.search(raw):
                texts = [raw[a:b] for a, b in zip(w.text_start, w.text_end, strict=True)]
                which = [i for i, x in enumerate(texts) if _ODD.search(x)]
                odd = dict(zip(which, self._plain([texts[i].decode() for i in which]), strict=True))
                keep = ~np.isin(doc - w.first, which)
                start, end, doc = start[keep], end[keep], doc[keep]
            yield w, raw, start, end, doc, odd

    def _ids(self, at: np.ndarray) -> np.ndarray:
        n = self.n[at]
        return self.ids[np.repeat(self.at[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

    def count(self, column: pa.Array, total: np.ndarray) -> int:
        """Add the ids' counts to ``total``; returns the number of documents. Only distinct chunks are looked at."""
        docs = 0
        for w, raw, start, end, _, odd in self._slices(column):
            u, first, n = np.unique(range_hashes(w.sums, start, end), return_index=True, return_counts=True)
            at = self.learn(u, first, start, end, raw)
            total += np.bincount(self._ids(at), np.repeat(n, self.n[at]), len(total)).astype(np.int64)
            for ids in odd.values():
                total += np.bincount(ids, minlength=len(total))
            docs += w.last - w.first
        return docs

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first document, ids, number of ids of each document) for slices of a string column."""
        for w, raw, start, end, doc, odd in self._slices(column):
            n_docs = w.last - w.first
            u, first, inverse = np.unique(range_hashes(w.sums, start, end), return_index=True, return_inverse=True)
            at = self.learn(u, first, start, end, raw)[inverse]
            ids = self._ids(at)
            lengths = np.bincount(doc - w.first, self.n[at], n_docs).astype(np.int64)
            if odd:
                parts, cut = [], np.append(0, np.cumsum(lengths))
                for i in range(n_docs):
                    parts.append(odd.get(i, ids[cut[i]:cut[i + 1]]))
                lengths = np.array([len(x) for x in parts], np.int64)
                ids = np.concatenate(parts)
            yield w.first, ids, lengths


def encoder(path: str, spaced: bool, run: str) -> Encoder:
    """This worker's encoder for one run of a query."""
    key = (path, spaced, run)
    if _WORKER.get("key") != key:
        _WORKER["key"], _WORKER["encoder"] = key, Encoder(path, spaced)
    return _WORKER["encoder"]


def append_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after every document, and the new lengths."""
    return np.insert(ids, np.cumsum(lengths), end).astype(np.uint32), lengths + 1
