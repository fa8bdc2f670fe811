"""Language-model scoring by a hierarchical Pitman-Yor model of word pairs.

Every word that occurs as a context owns a restaurant; its customers are the words that follow. All
contexts share one parent restaurant of words, whose customers are the tables of the contexts, and the
parent's parent is uniform over the known words and one unknown. A restaurant predicts

    P(w) = (c_w - d * t_w + (theta + d * t) * P_parent(w)) / (theta + c)

with c customers and t tables. The number of tables at which the customers of a word sit is sampled by
Gibbs, word by word, from its conditional given the others of the restaurant,

    p(t_w) ~ prod_{i < t_w} (theta + d * (t' + i)) * S_d(c_w, t_w) * P_parent(w)^t_w,

S_d the generalised Stirling numbers. Words with more than ``exact_customers`` customers are seated by
sequential draws in steps that grow with the number seated. Predictions are averaged over ``samples``.

Spark's part:

1. Tasks hash texts in blocks of words and send each block's distinct (context, word) pairs, with the
   documents that hold them, to the bucket of the context. Contexts with more than half a bucket's share
   of all tokens are spread over several buckets by their words.
2. Buckets sample the seating of their restaurants (parents estimated from the bucket) and send
   customers and tables per word to the bucket of the word.
3. There the parent restaurant adds up, is sampled, and answers each bucket that asked.
4. The parts of spread contexts are sampled under the shared parent, and the tables of every sample are added
   up over the parts (a few numbers per part and sample). So the sum over all words of their predictions is 1, as
   for the others.
5. Buckets sample again under the shared parent (spread contexts draw the same seats as in step 4) and turn the
   averaged predictions into sums per document, which meet by block. Repeated words of a block travel once.

Defined cases: null or empty texts hold only the end token; rows whose id is null are scored and
learnt from; repeated rows count as often as they occur and are scored each; without any training text
all words are unknown; extra columns are ignored; texts of any length are read whole; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.blobs import pack, unpack
from kpiloom.llm.spark import materialise
from kpiloom.llm.words import mix, slices

_U = np.uint64
_NONE = np.iinfo(np.int64).min      # a null document id
_MASK = _U((1 << 48) - 1)           # words are known by 48 bits of their hash
END = _U(0x1F2E3D4C5B6A)            # the end of a text; also the context of its first word


@dataclass(frozen=True)
class PitmanYor:
    discount: float = 0.75
    strength: float = 1.0
    parent_discount: float = 0.6
    parent_strength: float = 5.0
    burn_in: int = 2
    samples: int = 3
    exact_customers: int = 64
    block_words: int = 1_500_000
    bucket_bytes: int = 12 << 20    # text bytes per bucket, on average
    hash_modulus: int = 7           # a document whose crc32 leaves this remainder is held out
    held_out: int = 2
    seed: int = 11


def is_held_out(doc_id: int | None, cfg: PitmanYor) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % cfg.hash_modulus == cfg.held_out


@lru_cache(maxsize=4)
def log_stirling(discount: float, n: int) -> np.ndarray:
    """log S_d(c, t) for c, t up to n; S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t)."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(n):
        t = np.arange(1, c + 2)
        grow = np.full(c + 1, -np.inf)
        ok = (c - t * discount > 0) & np.isfinite(out[c, 1:c + 2])
        grow[ok] = np.log(c - t[ok] * discount) + out[c, 1:c + 2][ok]
        out[c + 1, 1:c + 2] = np.logaddexp(out[c, :c + 1], grow)
    return out


def seat(count: np.ndarray, tables: np.ndarray, house: np.ndarray, scale: np.ndarray, parent: np.ndarray,
         discount: float, strength: float, limit: int, rng: np.random.Generator) -> np.ndarray:
    """One Gibbs sweep over the dishes of all restaurants: new tables per dish.

    ``house`` numbers the restaurant of each dish; ``scale`` says how many times larger the whole
    restaurant is than its part seen here.
    """
    tables = tables.copy()
    total = np.bincount(house, tables, len(scale))
    stirling = log_stirling(discount, limit)
    order = np.argsort(count, kind="stable")
    sizes, first = np.unique(count[order], return_index=True)
    ends = np.append(first[1:], len(order))
    for c, a, b in zip(sizes.tolist(), first.tolist(), ends.tolist(), strict=True):
        if c < 2 or c > limit:
            continue
        for part in np.array_split(order[a:b], max(1, (b - a) * c // 2_000_000)):
            others = (total[house[part]] - tables[part]) * scale[house[part]]
            i = np.arange(c)
            rise = np.cumsum(np.log(strength + discount * (others[:, None] + i[None, :])), axis=1)
            weight = rise + stirling[c, 1:c + 1][None, :] + np.log(parent[part])[:, None] * (i + 1)[None, :]
            noise = rng.gumbel(size=weight.shape)
            new = np.argmax(weight + noise, axis=1) + 1
            np.add.at(total, house[part], new - tables[part])
            tables[part] = new
    large = order[int(np.searchsorted(count[order], limit, side="right")):]
    if len(large):
        others = (total[house[large]] - tables[large]) * scale[house[large]]
        n, t, c, p = np.ones(len(large)), np.ones(len(large)), count[large].astype(float), parent[large]
        while (n < c).any():
            step = np.minimum(np.maximum(1, n // 20), c - n)
            new = (strength + discount * (others + t)) * p
            t += rng.binomial(step.astype(np.int64), new / (new + np.maximum(n - discount * t, 1e-9)))
            n += step
        tables[large] = np.minimum(t, c)
    return tables


def _word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(words) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _pairs(cfg: PitmanYor, buckets: int, hot: dict[int, int]):
    """Rows (bucket, block, blob): the pairs of a block that belong to a bucket, and their documents."""
    names = np.array(sorted(hot), np.int64).view(_U)
    parts = np.array([hot[k] for k in sorted(hot)], np.int64)

    def emit(block, ids, train, words, docs):
        context = np.empty_like(words)
        context[0] = END
        context[1:] = words[:-1]
        key = mix(context * _U(0x9E3779B97F4A7C15) ^ words)
        order = np.argsort(key, kind="stable")        # documents stay in ascending order
        key, docs, context, words = key[order], docs[order], context[order], words[order]
        pair = np.ones(len(key), bool)
        pair[1:] = key[1:] != key[:-1]
        entry = pair.copy()
        entry[1:] |= docs[1:] != docs[:-1]
        e = np.flatnonzero(entry)
        times = np.diff(np.append(e, len(key)))
        p = np.flatnonzero(pair)
        per_pair = np.diff(np.append(np.searchsorted(e, p), len(e)))
        context, words, docs = context[p], words[p], docs[e]
        spread = np.zeros(len(p), np.int64)
        if len(names):
            at = np.searchsorted(names, context).clip(max=len(names) - 1)
            is_hot = names[at] == context
            spread[is_hot] = _word_bucket(words[is_hot], 1 << 20) % parts[at[is_hot]]
        bucket = (_word_bucket(context, buckets) + spread) % buckets
        by = np.lexsort((words, context, bucket))
        start = np.cumsum(per_pair) - per_pair
        take = np.repeat(start[by] - (np.cumsum(per_pair[by]) - per_pair[by]), per_pair[by]) + np.arange(len(e))
        bucket, context, words, per_pair, docs, times = bucket[by], context[by], words[by], per_pair[by], docs[take], times[take]
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        edge = np.append(0, np.cumsum(per_pair))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            d, k = docs[edge[a]:edge[b]], times[edge[a]:edge[b]]
            own, local = np.unique(d, return_inverse=True)
            runs = np.flatnonzero(np.append(True, context[a:b][1:] != context[a:b][:-1]))
            yield int(bucket[a]), block, pack(
                ids[own], train[own], own.astype(np.uint32), context[a:b][runs], np.diff(np.append(runs, b - a)).astype(np.uint32),
                _six(words[a:b]), per_pair[a:b].astype(np.uint32), local.astype(np.uint16 if len(own) < 65536 else np.uint32), k.astype(np.uint32))

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        ids, words, docs, n = [], [], [], 0

        def flush():
            train = np.array([not is_held_out(None if i == _NONE else i, cfg) for i in ids], np.uint8)
            rows = list(emit(block, np.array(ids, np.int64), train, np.concatenate(words), np.concatenate(docs)))
            for i in range(0, len(rows), 16):
                b, k, x = zip(*rows[i:i + 16], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(k, pa.int64()), pa.array(x, pa.binary())], ["bucket", "block", "blob"])

        for batch in batches:
            for w in slices(batch.column(1), True):
                got = batch.column(0).slice(w.first, w.last - w.first).to_pylist()
                at = w.bounds()
                words.append(np.insert(w.hash & _MASK, at[1:], END))
                docs.append(np.repeat(np.arange(len(ids), len(ids) + len(got)), np.diff(at) + 1))
                ids += [_NONE if x is None else x for x in got]
                n += len(words[-1])
                if n >= cfg.block_words:
                    yield from flush()
                    block, ids, words, docs, n = block + 1, [], [], [], 0
        if ids:
            yield from flush()
    return run


def _six(words: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)


def _from_six(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.view(_U).reshape(-1)


class _Bucket:
    """The pairs of a bucket, added up over its blocks."""

    def __init__(self, rows: pa.Table, cfg: PitmanYor, hot: dict[int, int], only_wide: bool = False):
        self.cfg, self.hot = cfg, hot
        self.blocks, context, words, per_pair, entries = [], [], [], [], []
        for block, blob in zip(rows["block"].to_pylist(), rows["blob"].to_pylist(), strict=True):
            ids, train, place, c, runs, w, n, local, times = unpack(blob)
            context.append(np.repeat(c, runs))
            words.append(_from_six(w))
            per_pair.append(n.astype(np.int64))
            learnt = np.add.reduceat(times * train[local].astype(np.int64), np.cumsum(per_pair[-1]) - per_pair[-1])
            entries.append(learnt)
            self.blocks.append((block, ids, place, local, times))
        self.per_pair = per_pair
        context, words, entries = np.concatenate(context), np.concatenate(words), np.concatenate(entries)
        self.words = np.unique(words)
        if only_wide:
            keep = np.isin(context, np.array(list(hot), np.int64).view(_U))
            context, words, entries = context[keep], words[keep], entries[keep]
        key = mix(context * _U(0x9E3779B97F4A7C15) ^ words)
        key, first, self.pair_of = np.unique(key, return_index=True, return_inverse=True)
        self.count = np.bincount(self.pair_of, entries, len(key)).astype(np.int64)
        self.contexts, self.house = np.unique(context[first], return_inverse=True)
        self.word = np.searchsorted(self.words, words[first])
        self.scale = np.array([hot.get(int(c), 1) for c in self.contexts.view(np.int64)], float)
        self.wide = np.isin(self.contexts, np.array(list(hot), np.int64).view(_U))

    def sweeps(self, parent: np.ndarray, n: int, start: np.ndarray | None, rng, dishes: np.ndarray | None = None) -> np.ndarray:
        """Tables per dish after ``n`` sweeps over the given dishes (None: all); the others have none."""
        learnt = (self.count > 0) if dishes is None else (self.count > 0) & dishes
        seen = np.flatnonzero(learnt)
        tables = learnt.astype(np.int64) if start is None else start.copy()
        for _ in range(n if len(seen) else 0):
            tables[seen] = seat(self.count[seen], tables[seen], self.house[seen], self.scale, parent[self.word[seen]],
                                self.cfg.discount, self.cfg.strength, self.cfg.exact_customers, rng)
        return tables

    def samples(self, parent: np.ndarray, me: int, wide: bool) -> Iterator[np.ndarray]:
        """Tables per dish in each sample, of the spread contexts or of the others.

        The two draw apart and independently of the order of rows, so the seats of spread contexts are the same
        whenever they are drawn.
        """
        rng, dishes = np.random.default_rng([self.cfg.seed, 2, me, int(wide)]), self.wide[self.house] == wide
        seats = self.sweeps(parent, self.cfg.burn_in, None, rng, dishes)
        for i in range(self.cfg.samples):
            seats = self.sweeps(parent, 1, seats, rng, dishes) if i else seats
            yield seats

    def totals(self, per_dish: np.ndarray) -> np.ndarray:
        """Sums per restaurant."""
        return np.bincount(self.house, per_dish, len(self.contexts)).astype(np.int64)


_ASK = "wbucket long, bucket long, blob binary"
_ANSWER = "bucket long, block long, blob binary"


def _ask(cfg: PitmanYor, buckets: int, hot: dict[int, int], tokens: int):
    def run(key, rows):
        b = _Bucket(rows, cfg, hot)
        me = key[0].as_py()
        local = np.bincount(b.word, b.count, len(b.words))
        rough = (local * buckets + 0.5) / (tokens + len(b.words) + 1.0)
        tables = b.sweeps(np.minimum(rough, 0.5), cfg.burn_in, None, np.random.default_rng([cfg.seed, me]))
        by_word = np.bincount(b.word, tables, len(b.words)).astype(np.int64)
        to = _word_bucket(b.words, buckets)
        order = np.argsort(to, kind="stable")
        cut = np.searchsorted(to[order], np.arange(buckets + 1))
        out = [(i, pack(_six(b.words[order[x:y]]), local[order[x:y]].astype(np.uint64), by_word[order[x:y]].astype(np.uint64)))
               for i, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x]
        return pa.table({"wbucket": pa.array([i for i, _ in out], pa.int64()), "bucket": pa.array([me] * len(out), pa.int64()),
                         "blob": pa.array([x for _, x in out], pa.binary())})
    return run


def _parent(cfg: PitmanYor, buckets: int):
    """The parent's dishes of one word bucket, answered to every bucket that asked; and their totals."""
    def run(key, rows):
        asked = [unpack(x) for x in rows["blob"].to_pylist()]
        words = [_from_six(a[0]) for a in asked]
        u, at = np.unique(np.concatenate(words), return_inverse=True)
        count = np.bincount(at, np.concatenate([a[1] for a in asked]), len(u)).astype(np.int64)
        customers = np.bincount(at, np.concatenate([a[2] for a in asked]), len(u)).astype(np.int64)
        rng = np.random.default_rng([cfg.seed, 1, key[0].as_py()])
        seen = np.flatnonzero(customers > 0)
        tables, house = (customers > 0).astype(np.int64), np.zeros(len(seen), np.int64)
        kept = np.zeros(len(u), np.int64)      # over all samples: whole numbers add up alike in any order
        flat = np.full(len(seen), 1.0 / (len(seen) * buckets + 1))
        for i in range(cfg.burn_in + cfg.samples):     # this bucket holds one of ``buckets`` parts of the root
            tables[seen] = seat(customers[seen], tables[seen], house, np.full(1, float(buckets)), flat, cfg.parent_discount, cfg.parent_strength,
                                cfg.exact_customers, rng)
            kept += tables * (i >= cfg.burn_in)
        mass = (int((count > 0).sum()), int(customers.sum()), int(kept.sum()))
        out, start = [], 0
        for me, w in zip(rows["bucket"].to_pylist(), words, strict=True):
            mine = at[start:start + len(w)]
            start += len(w)
            out.append((me, pack(count[mine].astype(np.uint64), customers[mine].astype(np.uint64), kept[mine].astype(np.uint64))))
        return pa.table({"bucket": pa.array([x for x, _ in out], pa.int64()), "block": pa.array([key[0].as_py()] * len(out), pa.int64()),
                         "blob": pa.array([x for _, x in out], pa.binary()),
                         **{c: pa.array([x] + [type(x)(0)] * (len(out) - 1)) for c, x in zip(("words", "customers", "tables"), mass, strict=True)}})
    return run


def _shared(b: _Bucket, answers: pa.Table, cfg: PitmanYor, buckets: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(count in training, probability under the shared parent) of the bucket's words, and its spread contexts:
    their names, customers and tables in each sample, added up over all parts."""
    known, customers_of_all, tables_of_all = (answers[c][0].as_py() for c in ("all_words", "all_customers", "all_tables"))
    to = _word_bucket(b.words, buckets)
    order = np.argsort(to, kind="stable")
    cut = np.searchsorted(to[order], np.arange(buckets + 1))
    count, customers, tables = np.zeros(len(b.words), np.int64), np.zeros(len(b.words)), np.zeros(len(b.words))
    wide = []
    for i, blob in zip(answers["block"].to_pylist(), answers["blob"].to_pylist(), strict=True):
        if i < 0:
            wide = unpack(blob)
            continue
        at = order[cut[i]:cut[i + 1]]
        count[at], customers[at], tables[at] = unpack(blob)
    d, s = cfg.parent_discount, cfg.parent_strength
    base = (s + d * tables_of_all / cfg.samples) / (known + 1)
    return count, (np.maximum(customers - d * tables / cfg.samples, 0) + base) / (s + customers_of_all), wide


_WIDE = "context long, part long, sample long, customers long, tables long"


def _seats(cfg: PitmanYor, buckets: int, hot: dict[int, int]):
    """Customers and tables of a bucket's part of every spread context, in each sample."""
    def run(key, rows, answers):
        me, b = key[0].as_py(), _Bucket(rows, cfg, hot, only_wide=True)
        customers, out = b.totals(b.count), []
        if len(b.contexts):
            _, parent, _ = _shared(b, answers, cfg, buckets)
            for i, seats in enumerate(b.samples(parent, me, True)):
                full = np.full(len(b.contexts), 1, np.int64)
                out.append((b.contexts.view(np.int64), full * me, full * i, customers, b.totals(seats)))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5
        return pa.table(dict(zip(("context", "part", "sample", "customers", "tables"), columns, strict=True)))
    return run


def _whole(cfg: PitmanYor):
    """One row per part: its spread contexts in order, their customers, their tables in each sample."""
    def run(key, rows):
        c, i, n, t = (rows[x].to_numpy() for x in ("context", "sample", "customers", "tables"))
        order = np.lexsort((c.view(_U), i))
        wide = len(c) // cfg.samples
        blob = pack(c[order][:wide].view(_U), n[order][:wide], *np.split(t[order], cfg.samples))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([-1], pa.int64()), "blob": pa.array([blob], pa.binary())})
    return run


def predictions(b: _Bucket, parent: np.ndarray, wide: list[np.ndarray], me: int) -> np.ndarray:
    """Probability of every pair of a bucket, averaged over the samples."""
    cfg = b.cfg
    d, s = cfg.discount, cfg.strength
    customers = b.totals(b.count)
    if wide:
        customers[b.wide] = wide[1]             # both ascend by context
    mean = np.zeros(len(b.count))
    for i, (cool, spread) in enumerate(zip(b.samples(parent, me, False), b.samples(parent, me, True), strict=True)):
        tables = b.totals(cool)
        if wide:
            tables[b.wide] = wide[2 + i]
        mean += (np.maximum(b.count - d * (cool + spread), 0) + (s + d * tables[b.house]) * parent[b.word]) / (s + customers[b.house])
    return mean / cfg.samples


def _score(cfg: PitmanYor, buckets: int, hot: dict[int, int]):
    def run(key, rows, answers):
        b = _Bucket(rows, cfg, hot)
        count, parent, wide = _shared(b, answers, cfg, buckets)
        score = np.log10(predictions(b, parent, wide, key[0].as_py()))
        base = np.log10(count[b.word] + 1.0)
        known = (count[b.word] > 0).astype(np.int64)
        out, at = [], 0
        for (block, ids, place, local, times), n in zip(b.blocks, b.per_pair, strict=True):
            pair = np.repeat(b.pair_of[at:at + len(n)], n)
            at += len(n)
            add = lambda x: np.bincount(local, x, len(ids))  # noqa: B023, E731
            out.append((block, pack(place, ids, add(times * score[pair]).astype(np.float32), add(times * base[pair]),
                                    add(times * known[pair]).astype(np.uint32), add(times).astype(np.uint32))))
        return pa.table({"block": pa.array([x for x, _ in out], pa.int64()), "blob": pa.array([x for _, x in out], pa.binary()),
                         "words": pa.array([answers["all_words"][0].as_py()] * len(out), pa.int64())})
    return run


def _add_up(cfg: PitmanYor, tokens: int):
    def run(key, rows):
        norm = float(np.log10(tokens + rows["words"][0].as_py() + 1.0))
        parts = [unpack(x) for x in rows["blob"].to_pylist()]
        place, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        ids = np.zeros(len(place), np.int64)
        ids[at] = np.concatenate([p[1] for p in parts])
        score, base, known, n = (np.bincount(at, np.concatenate([p[i] for p in parts]), len(place)) for i in (2, 3, 4, 5))
        null = ids == _NONE
        held = np.array([is_held_out(None if x == _NONE else x, cfg) for x in ids.tolist()], bool)
        return pa.table({"doc_id": pa.array(ids, mask=null), "held_out": pa.array(held), "n_tokens": pa.array(n.astype(np.int64)),
                         "n_known": pa.array(known.astype(np.int64)), "train_tokens": pa.array(np.full(len(ids), tokens, np.int64)),
                         "base_score": pa.array(base - n * norm), "score": pa.array(score)})
    return run


def frequent_contexts(texts: DataFrame, cfg: PitmanYor, buckets: int) -> tuple[int, dict[int, int]]:
    """(training tokens, number of parts of each context with over half a bucket's share of all tokens)."""
    floor = 1.0 / (4 * buckets)         # a word above twice this share is above it in batches that hold half its tokens

    def count(batches):
        for batch in batches:
            train = np.array([not is_held_out(x, cfg) for x in batch.column(0).to_pylist()], bool)
            tokens, learnt, words = 0, 0, []
            for w in slices(batch.column(1), True):
                words.append(w.hash & _MASK)
                tokens += len(w.hash) + w.last - w.first
                learnt += int(train[w.doc].sum() + train[w.first:w.last].sum())
            u, n = np.unique(np.concatenate(words), return_counts=True) if words else (np.zeros(0, _U), np.zeros(0))
            top = n >= floor * tokens
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.array([-1, -2, int(END)], np.int64), u[top].view(np.int64)])),
                pa.array(np.concatenate([[tokens, learnt, batch.num_rows], n[top]]).astype(np.int64))], ["w", "n"])

    rows = materialise(texts.mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "frequent")
    every = {r["w"]: r["n"] for r in rows.where("w < 0").collect()}
    tokens = every.get(-1, 0)
    top = rows.where((F.col("w") >= 0) & (F.col("n") * (2 * buckets) > tokens)).collect()       # fewer than 2 * buckets rows
    return every.get(-2, 0), {r["w"]: -(-2 * buckets * r["n"] // tokens) for r in top}


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(docs: DataFrame, cfg: PitmanYor = PitmanYor(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // cfg.bucket_bytes))
    tokens, hot = frequent_contexts(texts, cfg, buckets)
    pairs = texts.mapInArrow(_pairs(cfg, buckets, hot), "bucket long, block long, blob binary")
    asked = pairs.groupBy("bucket").applyInArrow(_ask(cfg, buckets, hot, tokens), _ASK)
    answers = asked.groupBy("wbucket").applyInArrow(_parent(cfg, buckets), _ANSWER + ", words long, customers long, tables long")
    totals = answers.agg(*[F.sum(c).alias("all_" + c) for c in ("words", "customers", "tables")])       # one row
    answers = answers.select("bucket", "block", "blob").crossJoin(F.broadcast(totals))
    if hot:
        part = pairs.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_seats(cfg, buckets, hot), _WIDE)
        every = Window.partitionBy("context", "sample")         # a row per part of a context
        part = part.select("context", "part", "sample", *[F.sum(c).over(every).alias(c) for c in ("customers", "tables")])
        wide = part.groupBy("part").applyInArrow(_whole(cfg), _ANSWER)
        answers = answers.union(wide.crossJoin(F.broadcast(totals)))
    parts = (pairs.groupBy("bucket").cogroup(answers.groupBy("bucket"))
             .applyInArrow(_score(cfg, buckets, hot), "block long, blob binary, words long"))
    return parts.groupBy("block").applyInArrow(_add_up(cfg, tokens), _RESULT).withColumnRenamed("doc_id", id_col)


def perplexity(scores: DataFrame, column: str = "score") -> DataFrame:
    """Perplexity per word of the held-out and of the training documents."""
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens")).alias("perplexity"))
