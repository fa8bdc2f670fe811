import hashlib
import random

import numpy as np
import pytest

from kpiloom.llm.bytespans import ByteRepeats, digests, without_repeats
from kpiloom.llm.interleave import last_to_first, merged, spelled, transform


def brute(rows, size):
    seen, out = set(), []
    done = {}
    for i, t in sorted({r for r in rows if r[0] is not None and r[1] is not None}):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - size + 1):
            if raw[s:s + size] in seen:
                gone[s:s + size] = True
            seen.add(raw[s:s + size])
        done[i, t] = gone
    for i, t in rows:
        raw = (t or "").encode()
        gone = done.get((i, t), np.zeros(len(raw), bool))
        spans = int((gone & ~np.append(False, gone[:-1])[:len(gone)]).sum())
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


SMALL = dict(slice_bytes=300, block_bytes=900, anchors=5, shard_bytes=500, group_bytes=800, bucket_bytes=200, longest_run=7, part_bytes=150)


@pytest.mark.parametrize("window,alphabet,more", [
    (12, "abcdeé ", SMALL), (12, "ab", SMALL | {"hot_count": 3, "hot_seeds": 20}), (100, "abcdefgh é", {}), (1, "abcdefghijkl", SMALL), (9, "a", SMALL)])
def test_random_against_brute_force(make_docs, window, alphabet, more):
    rng = random.Random(window)
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3 * window))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, window)))
                        for _ in range(rng.randint(0, 6)))) for i in range(40)]
    got = digests(make_docs(rows).repartition(3), ByteRepeats(window=window, **more))
    assert result(got) == brute(rows, window)


def test_edges(edge_docs):
    from tests.llm.conftest import EDGES
    assert result(digests(edge_docs, ByteRepeats())) == brute(EDGES, 100)
    assert result(digests(edge_docs, ByteRepeats(window=8, part_bytes=4000, hot_count=50))) == brute(EDGES, 8)


def test_strings_that_repeat_only_themselves(make_docs):
    rows = [(i, "".join(f"{i}-{k}{unit}" for k, unit in enumerate(["Wher. " * 20, "Th " * 50, "inwhorst " * 40, "ab" * 200]))) for i in range(3)]
    assert result(digests(make_docs(rows), ByteRepeats())) == brute(rows, 100)


def test_empty_table(no_docs):
    assert digests(no_docs).collect() == []


def test_columns_pass_through(make_docs):
    passage = "0123456789" * 12
    out = without_repeats(make_docs([(1, "x" + passage), (2, "é" + passage + "end"), (3, None)]), ByteRepeats(window=100))
    got = {r.doc_id: (bytes(r.kept), [tuple(s) for s in r.removed], r.id, r.version, r.node) for r in out.collect()}
    # The passage repeats itself every ten bytes, so its own later windows go too.
    assert got == {1: (b"x0123456789", [(11, 121)], "x", "y", "z"), 2: ("éend".encode(), [(2, 122)], "x", "y", "z"), 3: (b"", [], "x", "y", "z")}


def test_merged_transforms_are_sorted():
    rng = random.Random(0)
    for depth in (1, 3, 8, 9, 20):
        last, shard, strings = [], [], []
        for s in range(3):
            pool = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(8)}, key=lambda _: rng.random())
            size = np.array([len(x) + 1 for x in pool])
            got, names = transform(np.frombuffer(b"".join(x + b"\xff" for x in pool), np.uint8), np.cumsum(size) - size, size, np.zeros(len(pool), int))
            last.append(got)
            shard.append(np.full(len(got), s, np.uint16))
            strings += [pool[k] + b"\xff" for k in names]
        last, shard, size = np.concatenate(last), np.concatenate(shard), np.array([len(x) for x in strings])
        back = last_to_first(last, shard)
        text, place = spelled(last, back, size)
        assert text.tobytes() == b"".join(strings)
        at, group = merged(last, back, depth)
        owner, first = np.repeat(np.arange(len(size)), size), np.cumsum(size) - size
        rotation = [(strings[owner[p]] * (depth + 1))[p - first[owner[p]]:][:depth] for p in place[at]]
        assert rotation == sorted(rotation)
        assert [a == b for a, b in zip(rotation, rotation[1:], strict=False)] == (group[1:] == group[:-1]).tolist()


def sorted_values(monkeypatch):
    """List to which the number of values of each ``np.argsort`` is added."""
    sizes, plain = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *args, **more: (sizes.append(len(a)), plain(a, *args, **more))[1])
    return sizes


@pytest.mark.parametrize("buckets,alphabet", [(1, b"a"), (3, b"ab"), (300, bytes(range(97, 123)))])
def test_transform_is_sorted_by_bucket_and_rotation(monkeypatch, buckets, alphabet):
    rng = random.Random(buckets)
    texts = sorted({bytes(rng.choices(alphabet, k=rng.randint(2, 60))) for _ in range(600)}, key=lambda _: rng.random())
    pool = sorted(((rng.randrange(buckets), x) for x in texts), key=lambda x: x[0])
    size = np.array([len(x) + 1 for _, x in pool])
    sizes = sorted_values(monkeypatch)
    got, names = transform(np.frombuffer(b"".join(x + b"\xff" for _, x in pool), np.uint8), np.cumsum(size) - size, size, np.array([7 * b for b, _ in pool]))
    want = sorted((b, ((x + b"\xff") * 50)[k:k + 130], k, i) for i, (b, x) in enumerate(pool) for k in range(len(x) + 1))
    assert got.tobytes() == bytes((pool[i][1] + b"\xff")[k - 1] for _, _, k, i in want)
    assert names.tolist() == [w[3] for w in want if w[2] == 0]
    # Different texts are settled by one sort, but for a few ties.
    assert alphabet != bytes(range(97, 123)) or sum(sizes) < 2 * size.sum()


def test_many_shards_are_merged_in_rounds_of_double_depth(monkeypatch):
    rng = random.Random(1)
    strings = [bytes(rng.choices(b"abc", k=rng.choice([3, 40, 120]))) * rng.randint(1, 2) + b"\xff" for _ in range(300)]
    size = np.array([len(x) for x in strings])
    last = np.concatenate([transform(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]), np.array([0]))[0] for x in strings])
    back = last_to_first(last, np.repeat(np.arange(300), size))
    text, place = spelled(last, back, size)
    assert text.tobytes() == b"".join(strings)
    sizes = sorted_values(monkeypatch)
    at, group = merged(last, back, 100)
    assert len(sizes) <= 8          # not one for every eight bytes
    owner, first = np.repeat(np.arange(len(size)), size), np.cumsum(size) - size
    rotation = [(strings[owner[p]] * 30)[p - first[owner[p]]:][:100] for p in place[at]]
    assert rotation == sorted(rotation)
    assert [a == b for a, b in zip(rotation, rotation[1:], strict=False)] == (group[1:] == group[:-1]).tolist()
