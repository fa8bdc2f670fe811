"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

A window is ``window`` consecutive bytes of one document; each byte that a window covers which starts
earlier too (smaller document id, or same document and earlier start) is removed.

1. Anchors. A window is known by the smallest hash of the ``seed``-byte strings in it; consecutive windows
   with the same one are a run. Runs are counted by that hash: only windows of runs whose hash occurs
   twice, or twice inside the run, can repeat, and only they go on. A hash that occurs often in one block of texts leaves it once.
   The most frequent hashes (``hot_count`` or more runs, at most ``hot_seeds`` of them, which bounds what
   tasks carry along) are from then on the last choice, so that windows at the edges of a frequent
   passage are dealt by what is different in them.
2. Shards. Each task cuts the runs' strings out of whole texts and sorts the rotations of a shard's
   different strings, bucket by bucket (buckets by hash). What leaves the task is the Burrows-Wheeler
   transform of each bucket and the coordinates of its strings; a string that a shard holds several times
   leaves it once, its later places are repeats.
3. Merging. A bucket receives the transforms of all shards. Strings that are equal in several shards are
   joined; the transforms of what is left are merged by interleave refinement (``interleave.py``), and
   intervals with a common prefix of ``window`` bytes are the repeated windows. The first coordinate of
   an interval stays.
4. Spans meet their documents by a join on the id; there the bytes are cut.

Step 1 is a filter that may let windows through but loses none; equality is always decided on the bytes.

Defined cases: null and empty texts have no bytes; texts shorter than a window repeat nothing; rows
whose id is null are neither sources nor changed; rows with equal id and text are one document; rows
with equal id and other texts are ordered by a hash of their text; very long texts are read in parts that
overlap by a window; texts are UTF-8; an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.blobs import pack, unpack
from kpiloom.llm.interleave import END, last_to_first, merged, ranges, spelled, transform
from kpiloom.llm.spark import materialise
from kpiloom.llm.words import BYTE_VALUES, mix, text_buffers, window_hashes

_U = np.uint64
_COLD = _U((1 << 63) - 1)
_SPANS = ("id", "version", "start", "windows")


@dataclass(frozen=True)
class ByteRepeats:
    window: int = 100
    seed: int = 24              # bytes whose hash names a window
    longest_run: int = 128      # windows in one string, at most
    part_bytes: int = 1 << 20   # a longer text is read in parts
    slice_bytes: int = 1 << 19  # texts hashed at once
    block_bytes: int = 8 << 20  # texts whose anchors are counted before they leave a task
    anchors: int = 400_000      # anchors that one group counts, on average
    shard_bytes: int = 4 << 20  # string bytes in one shard
    group_bytes: int = 6 << 20  # string bytes that one group merges, on average
    bucket_bytes: int = 128 << 10
    hot_count: int = 10_000
    hot_seeds: int = 1 << 17

    @property
    def seed_bytes(self) -> int:
        return max(1, min(self.seed, self.window // 2))


def version_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def loops(seeds: np.ndarray, low: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a run may repeat itself: its seed leaves a window, as the first in it, and the run goes on."""
    left = np.append(0, np.cumsum(seeds[:len(low)] == low))
    return left[at + n - 1] > left[at]


@dataclass
class Slice:
    """Texts hashed together: ``text`` numbers them in their batches, ``base`` is where a part begins in its text."""

    data: np.ndarray
    text: np.ndarray            # per part
    base: np.ndarray
    first: np.ndarray           # place of each part in ``data``
    owner: np.ndarray           # part of each window
    valid: np.ndarray           # windows inside one part
    seeds: np.ndarray
    low: np.ndarray             # smallest seed of each window

    def runs(self, wanted: np.ndarray, low: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(first window, number) of the runs of wanted windows with one ``low``, the longer ones cut."""
        if not len(wanted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(len(wanted), bool)
        new[1:] = (low[1:] != low[:-1]) | (wanted[1:] != wanted[:-1]) | (self.owner[1:] != self.owner[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(wanted)))
        at, n = at[wanted[at]], n[wanted[at]]
        cuts = -(-n // longest)
        nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        at, n = np.repeat(at, cuts) + nth * longest, np.repeat(n, cuts) - nth * longest
        return at, np.minimum(n, longest)


def slices_of(texts: Iterator[tuple[int, np.ndarray]], cfg: ByteRepeats) -> Iterator[Slice]:
    """Slices over numbered texts; texts shorter than a window are left out."""
    def build(parts):
        size = np.array([len(p[2]) for p in parts])
        first = np.cumsum(size) - size
        data = np.concatenate([p[2] for p in parts])
        seeds = window_hashes(BYTE_VALUES[False][data], cfg.seed_bytes) & _COLD
        low = sliding_min(seeds, cfg.window - cfg.seed_bytes + 1)
        owner = np.repeat(np.arange(len(parts), dtype=np.int32), size)
        return Slice(data, np.array([p[0] for p in parts]), np.array([p[1] for p in parts]), first, owner[:len(low)],
                     owner[:len(low)] == owner[cfg.window - 1:], seeds, low)

    parts, size = [], 0
    for number, raw in texts:
        for a in range(0, len(raw) - cfg.window + 1, cfg.part_bytes):
            piece = raw[a:a + cfg.part_bytes + cfg.window - 1]
            parts.append((number, a, piece))
            size += len(piece)
            if size >= cfg.slice_bytes:
                yield build(parts)
                parts, size = [], 0
    if parts:
        yield build(parts)


def ordinals(s: Slice, at: np.ndarray, carry: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """(text, how many runs of its text come before) of each run; ``carry``: last text so far and its runs."""
    text = s.text[s.owner[at]]
    new = np.ones(len(text), bool)
    new[1:] = text[1:] != text[:-1]
    begin = np.flatnonzero(new)
    nth = np.arange(len(text)) - np.repeat(begin, np.diff(np.append(begin, len(text))))
    nth[text == carry[0]] += carry[1]
    last = int(s.text[-1])
    return text, nth, (last, int((text == last).sum()) + (carry[1] if last == carry[0] else 0))


def code_of(seed: np.ndarray, groups: int) -> np.ndarray:
    """Group (high half) and rest (low half) of a seed."""
    return (seed % _U(groups)) << _U(32) | (seed // _U(groups)) & _U(0xFFFFFFFF)


def _count(cfg: ByteRepeats, groups: int):
    """Texts (id, version, text) to rows (bucket, blob): the anchors of blocks, dealt by group."""
    def block(names, found):
        text, nth, code, times = (np.concatenate(c) for c in zip(*found, strict=True))
        if not len(code):
            return
        order = np.argsort(code, kind="stable")
        text, nth, code, times = text[order], nth[order], code[order], times[order]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        n = np.add.reduceat(times, first)
        many = np.repeat(n > 1, np.diff(np.append(first, len(code))))
        ids = np.array(names, np.int64)
        yield -1, pack(ids[text[many]], nth[many].astype(np.uint32))        # repeated in the block: known already
        text, nth, group = text[first], nth[first], (code[first] >> _U(32)).astype(np.int64)
        rest = (code[first] & _U(0xFFFFFFFF)).astype(np.uint32)
        ends = np.searchsorted(group, np.arange(groups + 1))
        for g in np.unique(group).tolist():
            a, b = ends[g], ends[g + 1]
            by = np.argsort(text[a:b], kind="stable")
            docs, which = np.unique(text[a:b][by], return_inverse=True)
            yield g, pack(ids[docs], which.astype(np.uint32), nth[a:b][by].astype(np.uint32), rest[a:b][by], n[a:b][by].astype(np.uint32))

    def run(batches):
        names, seen, found, size, carry = [], set(), [], 0, (-1, 0)

        def texts(batch):
            off, data = text_buffers(batch.column(2))
            for k, name in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if name not in seen:
                    seen.add(name)
                    names.append(name[0])
                    yield len(names) - 1, data[off[k]:off[k + 1]]

        def out(rows):
            keys, blobs = zip(*rows, strict=True) if (rows := list(rows)) else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

        for batch in batches:
            for s in slices_of(texts(batch), cfg):
                at, n = s.runs(s.valid, s.low, cfg.longest_run)
                text, nth, carry = ordinals(s, at, carry)
                found.append((text, nth, code_of(s.low[at], groups), 1 + loops(s.seeds, s.low, at, n)))
                size += len(s.data)
            if size >= cfg.block_bytes:
                yield out(block(names, found))
                names, seen, found, size, carry = [], set(), [], 0, (-1, 0)
        if found:
            yield out(block(names, found))
    return run


def _repeated_anchors(hot_count: int):
    """Rows of a group to (id, nth) of the anchors that repeat, and (code, total) of the hot ones."""
    def run(key, rows):
        blobs = [unpack(b) for b in rows["blob"].to_pylist()]
        if key[0].as_py() < 0:
            ids, nth = (np.concatenate(c) for c in zip(*blobs, strict=True))
            hot, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            ids = np.concatenate([b[0][b[1]] for b in blobs])
            nth, rest, n = (np.concatenate([b[k] for b in blobs]) for k in (2, 3, 4))
            code, back = np.unique(rest, return_inverse=True)
            sums = np.bincount(back, weights=n).astype(np.int64)
            hot = np.flatnonzero(sums >= hot_count)
            hot, total = (np.int64(key[0].as_py()) << 32) | code[hot].astype(np.int64), sums[hot]
            # Counted twice or more in its block: those are in the rows of bucket -1.
            single = (sums[back] > 1) & (n == 1)
            ids, nth = ids[single], nth[single]
        none = lambda n, kind: pa.nulls(n, kind)
        return pa.table({"id": pa.chunked_array([pa.array(ids, pa.int64()), none(len(hot), pa.int64())]),
                         "nth": pa.chunked_array([pa.array(nth.astype(np.int32), pa.int32()), none(len(hot), pa.int32())]),
                         "hot": pa.chunked_array([none(len(ids), pa.int64()), pa.array(hot, pa.int64())]),
                         "total": pa.chunked_array([none(len(ids), pa.int64()), pa.array(total, pa.int64())])})
    return run


def _shards(cfg: ByteRepeats, groups: int, hot: np.ndarray, merge_groups: int):
    """Texts (id, version, text, nth) to rows (bucket, head, last): transforms by group, and spans inside a shard."""
    per_group = max(1, cfg.group_bytes // cfg.bucket_bytes)
    buckets = merge_groups * per_group

    def wanted_windows(s, picks, carry):
        """Windows of the anchors that repeat."""
        at, n = s.runs(s.valid, s.low, cfg.longest_run)
        text, nth, carry = ordinals(s, at, carry)
        keep = np.zeros(len(at), bool)
        for t in np.unique(text).tolist():
            a, b = np.searchsorted(text, [t, t + 1])
            pick = picks[t] - nth[a]            # a text's runs are numbered one by one
            keep[a + pick[(pick >= 0) & (pick < b - a)]] = True
        mask = np.zeros(len(s.valid), bool)
        mask[ranges(at[keep], n[keep])] = True
        return mask, carry

    def strings(s, mask):
        """(part, start in its text, windows, seed, whether it may repeat itself, bytes) of the strings to be dealt."""
        low, ranked = s.low, s.seeds
        if len(hot) and np.isin(code_of(low[mask], groups), hot).any():
            ranked = np.where(np.isin(code_of(s.seeds, groups), hot), s.seeds | ~_COLD, s.seeds)
            low = sliding_min(ranked, cfg.window - cfg.seed_bytes + 1)
        at, n = s.runs(mask, low, cfg.longest_run)
        part = s.owner[at]
        loop = loops(ranked, low, at, n)
        raw = s.data.tobytes()
        return zip(part.tolist(), (at - s.first[part] + s.base[part]).tolist(), n.tolist(), mix(low[at]).tolist(), loop.tolist(),
                   [raw[a:a + k] for a, k in zip(at.tolist(), (n + cfg.window - 1).tolist(), strict=True)], strict=True)

    def shard(held):
        """Rows of one shard's strings (id, version, start, windows, seed, loop, bytes)."""
        held.sort(key=lambda x: x[:3])
        lead, again = {}, []
        for x in held:
            if lead.setdefault(x[6], x) is not x:
                again.append(x[:4])
        if again:
            yield -1, pack(*[np.array(c, np.int64) for c in zip(*again, strict=True)]), b""
        first = list(lead.values())
        seed = np.array([x[4] for x in first], _U)
        bucket = ((seed >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, size = bucket[order], np.array([len(first[k][6]) + 1 for k in order])
        # Sorted by as many buckets at once as fill a cache.
        border = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        nth = (np.cumsum(size) - size)[border] // cfg.bucket_bytes
        cuts = [*border[np.flatnonzero(np.append(True, nth[1:] != nth[:-1]))].tolist(), len(order)]
        last, names = [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            data = np.frombuffer(b"".join(first[k][6] + b"\xff" for k in order[a:b]), np.uint8)
            t, by = transform(data, np.cumsum(size[a:b]) - size[a:b], size[a:b], bucket[a:b])
            last.append(t)
            names.append(order[a:b][by])
        last, names = np.concatenate(last), np.concatenate(names)
        ids, versions, starts, windows = (np.array([first[k][c] for k in names], np.int64) for c in range(4))
        loop = np.array([first[k][5] for k in names])
        ends = np.cumsum(size)
        group = bucket // per_group
        cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            docs, which = np.unique(np.stack([ids[a:b], versions[a:b]]), axis=1, return_inverse=True)
            yield (int(group[a]), pack(bucket[a:b].astype(np.uint32), docs[0], docs[1], which.reshape(-1).astype(np.uint32), starts[a:b].astype(np.uint64),
                                       windows[a:b].astype(np.uint16), (seed[names[a:b]] & _U(0xFFFFFFFF)).astype(np.uint32), loop[a:b].astype(np.uint8)),
                   pack(last[ends[a] - size[a]:ends[b - 1]]))

    def run(batches):
        names, picks, seen, held, size, carry = [], [], set(), [], 0, (-1, 0)

        def texts(batch):
            off, data = text_buffers(batch.column(2))
            ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(len(ids)):
                if (ids[k], versions[k]) not in seen and batch.column(3)[k].is_valid:
                    seen.add((ids[k], versions[k]))
                    names.append((ids[k], versions[k]))
                    picks.append(np.asarray(batch.column(3)[k].values))
                    yield len(names) - 1, data[off[k]:off[k + 1]]

        def out(rows):
            keys, heads, lasts = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(heads, pa.binary()), pa.array(lasts, pa.binary())],
                                              ["bucket", "head", "last"])

        for batch in batches:
            for s in slices_of(texts(batch), cfg):
                mask, carry = wanted_windows(s, picks, carry)
                for part, start, n, seed, loop, raw in strings(s, mask):
                    held.append((*names[s.text[part]], start, n, seed, loop, raw))
                    size += len(raw) + 1
                if size >= cfg.shard_bytes:
                    yield out(shard(held))
                    held, size = [], 0
            if not held:
                names, picks, seen, carry = [], [], set(), (-1, 0)
        if held:
            yield out(shard(held))
    return run


def _spans(ids, versions, start, windows) -> pa.Table:
    return pa.table(dict(zip(_SPANS, (pa.array(np.asarray(c), pa.int64()) for c in (ids, versions, start, windows)), strict=True)))


def _merge_bucket(last, shard, ids, versions, starts, windows, seed, loop, cfg):
    """Repeated windows of one bucket as (string, first window, windows); strings and shards in one order."""
    size = windows + cfg.window                 # n windows, window - 1 bytes more, and the end
    back = last_to_first(last, shard)
    text, place = spelled(last, back, size)
    first = np.cumsum(size) - size
    raw, lead, again = text.tobytes(), {}, []
    order = np.lexsort((starts, versions, ids))
    # A window's place in the documents of the bucket, one document after the other.
    new = np.append(True, (ids[order][1:] != ids[order][:-1]) | (versions[order][1:] != versions[order][:-1]))
    begin = np.flatnonzero(new)
    lowest = starts[order][begin]
    extent = np.maximum.reduceat((starts + windows)[order], begin) - lowest
    spot = np.empty(len(ids), np.int64)
    spot[order] = starts[order] + (np.cumsum(extent) - extent - lowest)[np.cumsum(new) - 1]
    spots, ends = spot.tolist(), (first + size).tolist()
    for k, a in zip(order.tolist(), first[order].tolist(), strict=True):
        at = lead.setdefault(raw[a:ends[k]], k)
        if spots[at] != spots[k]:
            again.append(k)
    kept = np.fromiter(lead.values(), np.int64)
    # The only string of a seed has nothing to be merged with, unless it may repeat itself.
    _, which, n = np.unique(seed[kept], return_inverse=True, return_counts=True)
    kept = kept[(n[which] > 1) | (loop[kept] > 0)]
    again = np.array(again, np.int64)
    found = [(again, np.zeros(len(again), np.int64), windows[again])]
    if len(kept):
        held = np.zeros(len(ids), bool)
        held[kept] = True
        rank = np.repeat(held, size)[place]
        number = np.cumsum(rank) - 1
        at, group = merged(last[rank], number[back[rank]], cfg.window)
        here = place[rank][at]
        # Intervals of one rank repeat nothing.
        alone = np.append(True, group[1:] != group[:-1])
        alone &= np.append(alone[1:], True)
        here, group = here[~alone], group[~alone]
        string = np.repeat(np.arange(len(ids)), size)[here]
        offset = here - first[string]
        window = offset < windows[string]
        here, string, offset, group = here[window], string[window], offset[window], group[window]
        key = spot[string] + offset
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1])[:len(group)])
        source = np.minimum.reduceat(key, begin) if len(begin) else key
        moved = key != np.repeat(source, np.diff(np.append(begin, len(key))))
        # In the order of the strings, and of the windows in them.
        here = np.sort(here[moved])
        begin = np.flatnonzero(np.append(True, here[1:] != here[:-1] + 1)[:len(here)])
        string = np.searchsorted(first, here[begin], side="right") - 1
        found.append((string, here[begin] - first[string], np.diff(np.append(begin, len(here)))))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _merge(cfg: ByteRepeats):
    """Rows of a group to the spans of repeated windows."""
    def run(key, rows):
        if key[0].as_py() < 0:
            return _spans(*(np.concatenate(c) for c in zip(*map(unpack, rows["head"].to_pylist()), strict=True)))
        heads = [unpack(h) for h in rows["head"].to_pylist()]
        bucket = np.concatenate([h[0] for h in heads]).astype(np.int64)
        shard = np.repeat(np.arange(len(heads)), [len(h[0]) for h in heads])
        ids, versions = (np.concatenate([h[k][h[3]] for h in heads]) for k in (1, 2))
        starts, windows, seed, loop = (np.concatenate([h[k] for h in heads]) for k in (4, 5, 6, 7))
        starts, windows = starts.astype(np.int64), windows.astype(np.int64)
        last = np.concatenate([unpack(x)[0] for x in rows["last"].to_pylist()])
        size = windows + cfg.window
        place = np.cumsum(size) - size
        by = np.argsort(bucket, kind="stable")              # bucket after bucket, shards in order
        cuts = np.append(np.flatnonzero(np.append(True, bucket[by][1:] != bucket[by][:-1])), len(by))
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            k = by[a:b]
            # Lengths of a shard's strings in a bucket are in the order of its transform, which is contiguous.
            number = np.unique(shard[k], return_inverse=True)[1]
            owner = np.repeat(number.astype(np.uint16) if number[-1] < 1 << 16 else number, size[k])
            string, offset, n = _merge_bucket(last[ranges(place[k], size[k])], owner, ids[k], versions[k], starts[k], windows[k], seed[k], loop[k], cfg)
            out.append((ids[k][string], versions[k][string], starts[k][string] + offset, n))
        return _spans(*(np.concatenate(c) for c in zip(*out, strict=True)))
    return run


def repeated_windows(docs: DataFrame, cfg: ByteRepeats = ByteRepeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of repeated windows: id, version (hash of the text), start and windows."""
    texts = _texts(docs, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // (40 * cfg.anchors)))
    counted = texts.mapInArrow(_count(cfg, groups), "bucket long, blob binary")
    found = materialise(_dealt(counted, groups, "blob").applyInArrow(_repeated_anchors(cfg.hot_count), "id long, nth int, hot long, total long"), "anchors")
    hot = found.where("hot is not null").orderBy(F.col("total").desc(), "hot").limit(cfg.hot_seeds).select("hot").toPandas()["hot"]
    hot = np.sort(hot.to_numpy(np.int64).astype(_U))
    anchors = found.where("id is not null").select(F.col("id").alias("anchor_id"), "nth")
    merge_groups = max(1, -(-anchors.count() * (cfg.window + 40) // cfg.group_bytes))
    picked = anchors.groupBy("anchor_id").agg(F.collect_set("nth").alias("nth"))
    joined = texts.join(picked, texts["id"] == picked["anchor_id"]).select("id", "version", "text", "nth")
    shards = joined.mapInArrow(_shards(cfg, groups, hot, merge_groups), "bucket long, head binary, last binary")
    return _dealt(shards, merge_groups, "head").applyInArrow(_merge(cfg), "id long, version long, start long, windows long")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), version_of(text).alias("version"), text.alias("text")))


def _dealt(rows: DataFrame, groups: int, blob: str):
    """Rows by bucket; those of bucket -1, which need no meeting, over groups of their own."""
    deal = F.when(F.col("bucket") >= 0, F.lit(0)).otherwise(F.pmod(F.xxhash64(blob), F.lit(groups)))
    return rows.withColumn("deal", deal).groupBy("bucket", "deal")


def covered(runs: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Maximal byte ranges [from, to) covered by runs of windows (start, windows)."""
    out: list[list[int]] = []
    for s, n in sorted(runs):
        e = s + n - 1 + window
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def without_repeats(docs: DataFrame, cfg: ByteRepeats = ByteRepeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with ``kept`` (the bytes that stay; null text: empty) and ``removed`` (array of start and end)."""
    spans = repeated_windows(docs, cfg, id_col, text_col)
    found = spans.groupBy(F.col("id").alias("span_id_")).agg(F.collect_set(F.struct("version", "start", "windows")).alias("spans_"))

    @F.pandas_udf("struct<kept: binary, removed: array<struct<start: long, end: long>>>")
    def cut(text, version, spans):
        import pandas as pd

        kept, removed = [], []
        for t, v, runs in zip(text, version, spans, strict=True):
            raw, out, last = ("" if t is None else t).encode(), [], 0
            gone = covered([(x["start"], x["windows"]) for x in runs if x["version"] == v], cfg.window) if runs is not None else []
            for s, e in gone:
                out.append(raw[last:s])
                last = e
            kept.append(b"".join([*out, raw[last:]]))
            removed.append([{"start": s, "end": e} for s, e in gone])
        return pd.DataFrame({"kept": kept, "removed": removed})

    text = F.col(text_col).cast("string")
    joined = docs.join(found, F.col(id_col).cast("long") == F.col("span_id_"), "left")
    # Texts without spans stay in the JVM.
    has = F.col("spans_").isNotNull()
    mine = joined.withColumn("cut_", cut(F.when(has, text), version_of(text), F.col("spans_")))
    plain = F.coalesce(text, F.lit("")).cast("binary")
    return mine.select(*[docs[c] for c in docs.columns], F.when(has, F.col("cut_.kept")).otherwise(plain).alias("kept"),
                       F.when(has, F.col("cut_.removed")).otherwise(F.array().cast("array<struct<start: long, end: long>>")).alias("removed"))


def digests(docs: DataFrame, cfg: ByteRepeats = ByteRepeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans and kept_sha256."""
    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    out = without_repeats(slim, cfg, id_col, text_col)
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    return out.select(id_col, size.alias("n_bytes"), (size - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
