import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from kpiloom.llm.idfiles import IdFiles, decode_ranks, encode_ranks, id_file_digests, ranked_ids, write_id_files
from kpiloom.llm.packing import Packing, best_fit, pack
from kpiloom.llm.tokens import Encoder, tokenizer
from kpiloom.llm.wordpiece import build, byte_characters, piece_counts
from tests.llm.conftest import DOCS

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["a", "B", "é", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "1", "23", "!", "|", "||", "\u00a0", "\u3000", "\u0301", "the",
            "x<|endoftext|>", "漢字", "😀", "\x0b", "\x1c", " \n", "\n "]


@pytest.mark.parametrize("path,spaced", [(BYTES, True), (WORDS, False)])
def test_chunks_give_the_ids_of_whole_texts(path, spaced):
    rng = random.Random(2)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + [None, "", " "]
    e, plain = Encoder(path, spaced), tokenizer(path)
    got = [x for _, ids, n in e.encode(pa.array(texts, pa.string())) for x in np.split(ids, np.cumsum(n)[:-1])]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in got] == want
    total = np.zeros(e.size, np.int64)
    assert e.count(pa.array(texts, pa.string()), total) == len(texts)
    assert (total == np.bincount([i for x in want for i in x], minlength=e.size)).all()


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_variable_length_round_trip(ranks):
    control, data = encode_ranks(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4) and len(data) == sum(max(1, (r.bit_length() + 7) // 8) for r in ranks)
    assert decode_ranks(control, data, len(ranks)).tolist() == ranks


def test_id_files_of_edges(edge_docs, no_docs):
    from tests.llm.conftest import EDGES
    got = sorted([tuple(r) for r in id_file_digests(edge_docs.repartition(3), IdFiles(BYTES, block_ids=1000, shard_bytes=100_000)).collect()],
                 key=lambda r: r[1])
    t = tokenizer(BYTES)
    ids = {(i, x): np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4") for i, x in EDGES}
    assert [r[0] for r in got] == sorted((i for i, _ in EDGES), key=lambda i: (i is not None, i))       # null ids first
    assert [r[1] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]                 # gapless
    assert sorted((r[0], r[2], r[3]) for r in got if r[0]) == sorted((i, len(ids[i, x]), zlib.crc32(ids[i, x].tobytes())) for i, x in EDGES if i)
    assert id_file_digests(no_docs, IdFiles(BYTES)).collect() == []


@pytest.mark.parametrize("end_id", [0, 70_000])
def test_id_files_read_each_text_once(spark, make_docs, end_id):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(200)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = make_docs(rows).repartition(4).mapInArrow(counted, DOCS)
    got = sorted(tuple(r) for r in id_file_digests(docs, IdFiles(BYTES, end_id=end_id, block_ids=100, shard_bytes=5000)).collect())
    assert read.value == len(rows)
    ids = [np.array(x.ids + [end_id], "<u4") for x in tokenizer(BYTES).encode_batch([x for _, x in rows], add_special_tokens=False)]
    starts = np.cumsum([0] + [len(x) for x in ids]).tolist()
    assert got == [(i, starts[i], len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)]


def test_blocks_end_with_the_document_that_fills_them(spark, make_docs, tmp_path):
    docs = make_docs([(i, "one two three four five " * (1 + i % 30)) for i in range(300)])
    write_id_files(docs, IdFiles(BYTES, block_ids=500, shard_bytes=20_000), str(tmp_path / "files"))
    rows = spark.read.parquet(str(tmp_path / "files")).orderBy("shard", "block").collect()
    assert [i for r in rows for i in r.doc_ids] == list(range(300)) and len({r.shard for r in rows}) > 1
    for r, after in zip(rows, [*rows[1:], None], strict=True):
        if after is not None and after.shard == r.shard:
            assert sum(r.lengths) >= 500 and after.block == r.block + 1
        assert sum(r.lengths[:-1]) < 500


def test_ranks_follow_counts(make_docs):
    by_rank = ranked_ids(make_docs([(1, "the the the cat"), (2, " the")]), IdFiles(BYTES), "test")
    t = tokenizer(BYTES)
    assert by_rank[0] == t.encode(" the").ids[0] and by_rank[1] == 0 and len(set(by_rank.tolist())) == len(by_rank)


def check_packing(df, rows, cfg):
    t = tokenizer(WORDS)
    want = []
    for i, x in rows:
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, k // cfg.capacity, k, len(ids[k:k + cfg.capacity]), zlib.crc32(ids[k:k + cfg.capacity].tobytes())) for k in range(0, len(ids), cfg.capacity)]
    got = df.toPandas()
    assert sorted([tuple(None if x != x else int(x) for x in r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)], key=str) == sorted(want, key=str)
    bins = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (bins["length"].cumsum() - got["length"] == got["offset"]).all()
    assert bins["length"].sum().max() <= cfg.capacity and bins.size().max() <= cfg.max_docs
    assert bins["length"].apply(lambda x: (x**2).sum()).max() <= cfg.max_cost
    return got


def test_packing_of_edges(edge_docs, no_docs):
    from tests.llm.conftest import EDGES
    cfg = Packing(WORDS)
    got = check_packing(pack(edge_docs, cfg), EDGES, cfg)
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 4096) + 1
    assert pack(no_docs, cfg).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_keeps_every_capacity(edge_docs, rule):
    from tests.llm.conftest import EDGES
    cfg = Packing(WORDS, capacity=64, max_docs=3, max_cost=64 * 64, rule=rule, group_pieces=100)
    check_packing(pack(edge_docs, cfg), EDGES, cfg)


def test_best_fit_is_exact_on_halves_and_refuses_what_cannot_fit():
    where, offset = best_fit(np.array([3, 5, 6, 2, 4, 4]), Packing(WORDS, capacity=8, max_cost=64))
    assert len(set(where.tolist())) == 3 and (np.bincount(where, [3, 5, 6, 2, 4, 4]) == 8).all()
    with pytest.raises(ValueError):
        best_fit(np.array([8]), Packing(WORDS, capacity=8, max_cost=63))


def greedy(word, starts, continuations):
    i = n = 0
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in (starts if i == 0 else continuations)), 0)
        if not j:
            return -1
        n, i = n + 1, j
    return n


def test_automaton_is_greedy_longest_match():
    rng = random.Random(3)
    make = lambda k: bytes(rng.choice(b"abc") for _ in range(rng.randint(1, k)))
    for _ in range(200):
        starts, more, words = [{make(5) for _ in range(rng.randint(1, 9))} for _ in range(2)] + [[make(14) for _ in range(40)]]
        size = np.array([len(x) for x in words])
        got = build(sorted(starts), sorted(more)).lengths(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, np.cumsum(size))
        assert got.tolist() == [greedy(x, starts, more) for x in words]


def test_piece_counts_equal_a_wordpiece_model(edge_docs, no_docs):
    from tests.llm.conftest import EDGES
    from kpiloom.llm.wordpiece import byte_level_pieces
    to_char = {b: c for c, b in byte_characters().items()}
    text = lambda raw: "".join(to_char[b] for b in raw)
    starts, more = byte_level_pieces(BYTES)
    vocabulary = {x: i for i, x in enumerate(["[UNK]", *[text(x) for x in starts], *["##" + text(x) for x in more]])}
    t = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**6))
    t.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    got = sorted([tuple(r) for r in piece_counts(edge_docs, BYTES).collect()], key=str)
    want = []
    for i, x in EDGES:
        words = (x or "").encode().split()
        tokens = [t.encode(text(w)).tokens for w in words]
        want.append((i, len(words), sum(k == ["[UNK]"] for k in tokens), sum(map(len, tokens))))
    assert got == sorted(want, key=str)
    assert piece_counts(no_docs, BYTES).collect() == []
