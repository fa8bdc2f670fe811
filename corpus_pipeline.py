"""Corpus pipeline: from raw documents to packed training sequences.

Stages, in order: documents judged toxic go; one document of each group of near duplicates stays; word
windows that occur earlier are cut out of the texts; documents that hold benchmark items go; what is
left is packed. Each stage takes all its predecessor kept, as a table written and read again; all but
the last return the columns of ``documents`` (n_chars follows the text).

Null texts pass every filter and are packed as the end id alone; null ids are never removed as copies;
rows repeated with id and text leave one; texts that share an id are judged each for itself; extra columns pass through; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.decontaminate import Latent, without_leaks
from kpiloom.llm.minhash import MinHash, copies, text_print
from kpiloom.llm.packing import Packing, pack
from kpiloom.llm.queries import vocabulary
from kpiloom.llm.spark import materialise, prepare, table
from kpiloom.llm.substring import Repeats, remove_repeats
from kpiloom.llm.toxicity import Toxicity, fit, without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject; it learns from their labels."""
    prepare(spark)
    cfg = Toxicity()
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels"), cfg), cfg)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 similarity of five-word shingles."""
    prepare(spark)
    gone = copies(docs, MinHash(shingle=5)).toDF("gone_id_", "gone_print_")
    kept = docs.join(gone, (docs["doc_id"] == F.col("gone_id_")) & (text_print("text") == F.col("gone_print_")), "left_anti")
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(1))
    nth = "nth_of_equal_rows_"
    return kept.withColumn(nth, F.row_number().over(same)).where((F.col(nth) == 1) | F.col("doc_id").isNull()).drop(nth)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that occur earlier."""
    prepare(spark)
    cut = remove_repeats(docs, Repeats(window=50))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), Latent())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of 4096 tokens."""
    prepare(spark)
    return pack(docs, Packing(vocabulary("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_sequences),
]

# SQL cannot express the fitted and hashed stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
