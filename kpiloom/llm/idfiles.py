"""Token-id files: frequency-ranked ids, byte-aligned variable length, control bytes kept apart.

An id is replaced by its rank among the corpus's ids by count, so frequent ids are small numbers. Four
ranks share a control byte (two bits each: one to four bytes); the ranks' bytes follow in a data stream
of their own. Decoding is numpy only: a table turns control bytes into lengths, running sums into places.

The files are a Parquet table in a shared folder, in ascending order of document id: each row is a
block of whole documents (shard, block, doc_ids, lengths, control, data), a shard is a range of ids.
Writing goes through Spark's committer, so lost tasks leave no partial files. Each text is encoded once,
into a table of plain ids in the shared folder. Ranks come from one pass over that table (counts as long
as the vocabulary); a second one orders its documents by range and sort and writes their ranks.

Defined cases: null texts are empty (the end id alone); null ids come first; repeated ids keep one
entry per row, ordered by id and then by a hash of their text; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.spark import materialise
from kpiloom.llm.tokens import append_end, encoder
from kpiloom.session import scratch_path

# Lengths of the four values of each control byte, and their sum.
LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.int64)


@dataclass(frozen=True)
class IdFiles:
    tokenizer: str              # path of the tokenizer's file
    spaced: bool = True
    end_id: int = 0             # appended to every document
    shard_bytes: int = 32 << 20  # text bytes per shard, on average
    block_ids: int = 1 << 18    # ids per block, at least (whole documents)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of non-negative 32-bit numbers."""
    n = len(ranks)
    size = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    code = np.zeros(-(-n // 4) * 4, np.uint8)
    code[:n] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    raw = np.ascontiguousarray(ranks.astype("<u4")).view(np.uint8).reshape(n, 4)
    return control.astype(np.uint8).tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.append(np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)).astype(np.uint32)
    at = np.cumsum(size) - size
    out = raw[at]
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= raw[at[more] + k] << np.uint32(8 * k)
    return out


def encoded(texts: DataFrame, cfg: IdFiles, run: str) -> DataFrame:
    """Ids of (id, text) rows, end id included: 2 bytes each, or 4 if the vocabulary needs them; n of them."""
    def encode(batches):
        for batch in batches:
            enc = encoder(cfg.tokenizer, cfg.spaced, run)
            kind = np.dtype("<u2" if max(enc.size - 1, cfg.end_id) < 1 << 16 else "<u4")
            for first, found, n in enc.encode(batch.column(3)):
                found, n = append_end(found, n, cfg.end_id)
                offsets = (np.append(0, np.cumsum(n)) * kind.itemsize).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(found.astype(kind))])
                yield pa.RecordBatch.from_arrays([*(c.slice(first, len(n)) for c in batch.columns[:3]), pa.array(n), ids],
                                                 ["id", "text_hash", "text_bytes", "n", "ids"])

    rows = texts.select("id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").cast("long").alias("text_bytes"), "text")
    return rows.mapInArrow(encode, "id long, text_hash long, text_bytes long, n long, ids binary")


def plain_ids(n: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each row, all ids) of rows as ``encoded`` leaves them."""
    n = n.to_numpy()
    _, offsets, data = ids.buffers()
    at = np.frombuffer(offsets, np.int32)[ids.offset:ids.offset + len(ids) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    return n, raw.view(f"<u{len(raw) // int(n.sum())}")        # a row has its end id at least


def ranked_ids(docs: DataFrame, cfg: IdFiles, run: str, coded: bool = False) -> np.ndarray:
    """All ids from the most to the least frequent (ties: smaller id), counted over the whole corpus.

    The documents are texts or, if ``coded``, as ``encoded`` leaves them.
    """
    def count(batches):
        total = None
        for batch in batches:
            enc = encoder(cfg.tokenizer, cfg.spaced, run)
            total = np.zeros(max(enc.size, cfg.end_id + 1), np.int64) if total is None else total
            if coded:
                total += np.bincount(plain_ids(batch.column(0), batch.column(1))[1], minlength=len(total))
            else:
                total[cfg.end_id] += enc.count(batch.column(0), total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["token", "n"])

    rows = (docs.select(*(["n", "ids"] if coded else [F.col("text").cast("string")])).mapInArrow(count, "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).toPandas())      # as many rows as the vocabulary has
    return rows.sort_values(["n", "token"], ascending=[False, True])["token"].to_numpy(np.uint32)


def write_id_files(docs: DataFrame, cfg: IdFiles, path: str, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Write the files; returns the ids by rank, which readers need."""
    run = uuid.uuid4().hex
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    coded = materialise(encoded(texts, cfg, run), "plain-ids", compression="zstd")
    by_rank = ranked_ids(coded, cfg, run, coded=True)
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    total = coded.agg(F.sum("text_bytes")).first()[0] or 0
    shards = max(1, -(-total // cfg.shard_bytes))

    def write(batches):
        from pyspark import TaskContext

        shard, block, doc_ids, lengths, ids, size = TaskContext.get().partitionId(), 0, [], [], [], 0

        def flush():
            control, data = encode_ranks(np.concatenate(ids))
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int64()), pa.array([block], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([np.concatenate(lengths)], pa.list_(pa.int64())), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                ["shard", "block", "doc_ids", "lengths", "control", "data"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            n, found = plain_ids(batch.column(1), batch.column(2))
            ends = np.append(0, np.cumsum(n))
            first = 0
            while first < len(n):               # a block ends with the document that fills it
                last = min(len(n), int(np.searchsorted(ends, ends[first] + cfg.block_ids - size)))
                doc_ids += names[first:last]
                lengths.append(n[first:last])
                ids.append(rank[found[ends[first]:ends[last]]])
                size += int(ends[last] - ends[first])
                if size >= cfg.block_ids:
                    yield flush()
                    block, doc_ids, lengths, ids, size = block + 1, [], [], [], 0
                first = last
        if doc_ids:
            yield flush()

    ordered = (coded.select("id", "n", "ids", "text_hash").repartitionByRange(shards, F.col("id").asc_nulls_first())
               .sortWithinPartitions(F.col("id").asc_nulls_first(), "text_hash").select("id", "n", "ids"))
    ordered.mapInArrow(write, "shard long, block long, doc_ids array<long>, lengths array<long>, control binary, data binary").write.parquet(path)
    return by_rank


def read_id_files(spark: SparkSession, path: str, by_rank: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: id, start (ids before it), n_tokens and ids_crc32 of its decoded ids."""
    blocks = spark.read.parquet(path)
    sizes = blocks.select("shard", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("size"))
    shard = sizes.groupBy("shard").agg(F.sum("size").alias("size"))
    before = shard.select("shard", (F.sum("size").over(Window.orderBy("shard")) - F.col("size")).alias("shard_start"))
    starts = sizes.join(before, "shard").select("shard", "block", (F.col("shard_start") + F.sum("size").over(
        Window.partitionBy("shard").orderBy("block")) - F.col("size")).alias("block_start"))

    def decode(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                lengths = np.asarray(batch.column(1)[row].values, np.int64)
                ids = by_rank[decode_ranks(batch.column(2)[row].as_py(), batch.column(3)[row].as_py(), int(lengths.sum()))]
                ids = np.ascontiguousarray(ids.astype("<u4"))
                ends = np.cumsum(lengths)
                at = ends - lengths
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[row].values, pa.array(at + batch.column(4)[row].as_py()),
                                                  pa.array(lengths), pa.array(crc, pa.int64())], [id_col, "start", "n_tokens", "ids_crc32"])

    joined = blocks.join(starts, ["shard", "block"]).select("doc_ids", "lengths", "control", "data", "block_start")
    return joined.mapInArrow(decode, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def id_file_digests(docs: DataFrame, cfg: IdFiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the id files to the shared folder and describe what they hold."""
    spark = docs.sparkSession
    path = scratch_path(spark, "id-files")
    return read_id_files(spark, path, write_id_files(docs, cfg, path, id_col, text_col), id_col)
