"""Importance resampling towards a target text, on n-gram features found by one overlapped regex scan.

A text's runs of separators become single spaces; then, for each length, one pattern with boundary
lookarounds is scanned with ``overlapped=True``: every match is the span of one n-gram, whose bytes are
counted by their CRC-32 in a fixed number of buckets.

1. One pass over the documents finds their buckets. It is written to the shared folder (two bytes a
   feature, packed), so no text is scanned twice; a task adds its buckets up before its counts leave it.
2. The gain of a bucket compares its share of the target with its share of the documents. There are as
   many gains as buckets, a parameter, and they travel as one small array.
3. A document's weight is the sum of its gains. With Gumbel noise from the hash of its id, the highest
   scores are a sample without replacement. Ranks come from a range partitioning by score: counts per
   range shift the places inside a range, so no task orders all documents.

Defined cases: a null text has no features; null, empty and short texts weigh the sum they have and are
not drawn below ``min_words``; rows with a null id add to the counts but have no score and no rank;
repeated rows are documents of their own; equal scores go by id, then by number of features and weight
(rows that are equal in all of these take either place). Very long texts are scanned whole, as
an iterator. An empty table gives no rows; with an empty target every gain is that of zero counts. Extra
columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.blobs import pack, unpack
from kpiloom.llm.spark import materialise

SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Importance:
    longest: int = 1            # words per feature, from one to this
    buckets: int = 10_000
    min_words: int = 20         # shorter documents are not drawn
    percent: int = 10           # of the documents that are long enough
    seed: str = "2024"
    range_rows: int = 1_000_000  # rows per range of the ranking, on average


def patterns(longest: int) -> list[regex.Pattern]:
    """One pattern per length: whole words between boundaries."""
    return [regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1)) for n in range(1, longest + 1)]


def feature_spans(text: str | None, longest: int = 1):
    """The text as scanned, and the spans of its n-grams, shorter ones first."""
    raw = SEPARATORS.sub(b" ", (text or "").encode().lower())
    return raw, (m.span() for p in patterns(longest) for m in p.finditer(raw, overlapped=True))


def feature_buckets(text: str | None, cfg: Importance) -> np.ndarray:
    raw, spans = feature_spans(text, cfg.longest)
    crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in spans), np.uint32)
    return crc % np.uint32(cfg.buckets)


def scanned(texts: DataFrame, cfg: Importance) -> DataFrame:
    """Per row of ``texts(id, text)``: id, n_words, n_features and the packed buckets (different ones, and how often)."""
    kind = np.uint16 if cfg.buckets <= 1 << 16 else np.uint32

    def run(batches):
        for batch in batches:
            words, features, blobs = [], [], []
            for text in batch.column(1):
                found, n = np.unique(feature_buckets(text.as_py(), cfg), return_counts=True)
                total = int(n.sum())
                # Of k words, k + (k-1) + ... spans are features.
                k = total if cfg.longest == 1 else len(patterns(1)[0].findall(SEPARATORS.sub(b" ", (text.as_py() or "").encode().lower())))
                words.append(k)
                features.append(total)
                blobs.append(pack(found.astype(kind), n.astype(np.uint8 if n.max(initial=0) < 256 else np.uint32)) if total else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                                              pa.array(blobs, pa.binary())], ["id", "n_words", "n_features", "found"])

    return texts.mapInArrow(run, "id long, n_words long, n_features long, found binary")


def bucket_counts(rows: DataFrame, cfg: Importance) -> np.ndarray:
    """Features per bucket; a task adds up its rows first."""
    def run(batches):
        total = np.zeros(cfg.buckets, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                found, n = unpack(blob.as_py())
                total[found] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = rows.where("found is not null").select("found").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(cfg.buckets, np.int64)
    for r in counts.collect():          # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed shares' ratio) of every bucket."""
    n = len(source)
    above = (target + 1.0) * (source.sum() + n)
    below = (source + 1.0) * (target.sum() + n)
    return np.floor(1000.0 * np.log(above / below)).astype(np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows with ``weight``, the sum of their features' gains."""
    def run(batches):
        for batch in batches:
            weights = []
            for blob in batch.column(3):
                found, n = unpack(blob.as_py()) if blob.is_valid else (np.zeros(0, int), np.zeros(0, int))
                weights.append(int((gain[found] * n.astype(np.int64)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], ["id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def noise(name: Column, seed: str) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of the id's sha256."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(seed + ":"), name.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def ranked(rows: DataFrame, order: list[Column], drawn: int, ranges: int) -> DataFrame:
    """``rows`` with ``rank`` 1.. by ``order`` for the first ``drawn``, null for the others.

    Ranges are written once, so the places in them are fixed; as many counts as ranges are gathered.
    """
    def place(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))],
                                             [*batch.schema.names, "range", "place"])
            at += n

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = materialise(dealt.mapInArrow(place, f"{fields}, range int, place long"), "ranges")
    counts = sorted((r["range"], r["n"]) for r in placed.groupBy("range").agg(F.count("*").alias("n")).collect())
    before, shift = 0, []
    for part, n in counts:
        shift.append((part, before))
        before += n
    starts = rows.sparkSession.createDataFrame(shift or [(0, 0)], "range int, before long")
    rank = F.col("before") + F.col("place") + F.lit(1)
    return placed.join(F.broadcast(starts), "range").withColumn("rank", F.when(rank <= drawn, rank)).drop("range", "place", "before")


def resampled(docs: DataFrame, target: DataFrame, cfg: Importance = Importance(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_features, weight, score and rank (null: not drawn)."""
    read = lambda df, name: df.select(name.cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialise(scanned(read(docs, F.col(id_col)), cfg), "features")
    gain = gains(bucket_counts(rows, cfg), bucket_counts(scanned(read(target, F.lit(None)), cfg), cfg))
    score = F.col("weight") + noise(F.col("id"), cfg.seed)
    scored = materialise(weighted(rows, gain).withColumn("score", score), "scores")
    enough = (F.col("n_words") >= cfg.min_words) & F.col("id").isNotNull()
    n = scored.where(enough).count()
    order = [F.col("score").desc(), F.col("id"), F.col("n_features"), F.col("weight")]
    drawn = ranked(scored.where(enough), order, cfg.percent * n // 100, max(1, -(-n // cfg.range_rows)))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).withColumnRenamed("id", id_col)
