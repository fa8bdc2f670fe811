"""Registered queries of the text operators; each reads whole tables and returns its whole result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.bytespans import ByteRepeats, digests
from kpiloom.llm.decontaminate import Latent, leaks
from kpiloom.llm.idfiles import IdFiles, id_file_digests
from kpiloom.llm.importance import Importance, resampled
from kpiloom.llm.minhash import MinHash, near_duplicates
from kpiloom.llm.oracles import OP11_SQL, OP12_SQL, OP13_SQL
from kpiloom.llm.packing import Packing, pack
from kpiloom.llm.pitmanyor import PitmanYor, score_texts
from kpiloom.llm.spark import prepare, table
from kpiloom.llm.spelling import Spelling, variants
from kpiloom.llm.substring import Repeats, kept_words
from kpiloom.llm.topk import TopK, top_k
from kpiloom.llm.toxicity import Toxicity, fit, severity
from kpiloom.llm.urls import UrlFilter, judged
from kpiloom.llm.wordpiece import piece_counts


def op1_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the add-one base and the hierarchical model."""
    prepare(spark)
    return score_texts(table(spark, sf_dir, "documents"), PitmanYor())


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    prepare(spark)
    return judged(table(spark, sf_dir, "pages"), UrlFilter())


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece length of every document."""
    prepare(spark)
    return piece_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every 50th vector among all other vectors."""
    prepare(spark)
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, TopK())


OP4_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
  from embeddings
  where embedding is not null and len(embedding) > 0 and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and q.vec_id % 50 = 0 and len(q.e) = len(c.e)
)
select query_id, rank::integer as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""


def op5_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and verdict of every document."""
    prepare(spark)
    docs, cfg = table(spark, sf_dir, "documents"), Toxicity()
    return severity(docs, fit(docs, table(spark, sf_dir, "labels"), cfg), cfg)


def op6_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the id files of all documents hold, read back."""
    prepare(spark)
    return id_file_digests(table(spark, sf_dir, "documents"), IdFiles(vocabulary("byte_bpe_50k.json")))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens."""
    prepare(spark)
    return pack(table(spark, sf_dir, "documents"), Packing(vocabulary("word_bpe_49k.json")))


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and which."""
    prepare(spark)
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Latent())


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 20-word windows that occur earlier."""
    prepare(spark)
    return kept_words(table(spark, sf_dir, "documents"), Repeats(window=20))


OP9_SQL = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), starts as (
  select doc_id, words, unnest(range(1, len(words) - 18)) as s from w
), repeats as (
  select doc_id, s from (
    select doc_id, s, row_number() over (partition by array_to_string(words[s:s + 19], ' ') order by doc_id, s) as n from starts)
  where n > 1
), gone as (
  select distinct doc_id, unnest(range(s, s + 20)) as p from repeats
), places as (
  select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from w
), kept as (
  select doc_id, string_agg(word, ' ' order by p) as text, count(*) as n from places anti join gone using (doc_id, p) group by doc_id
)
select w.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)
"""


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles have similarity 0.8 or more."""
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), MinHash(shingle=2))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw towards the benchmark texts."""
    prepare(spark)
    drawn = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Importance())
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, with the form and the root that each is a variant of."""
    prepare(spark)
    return variants(table(spark, sf_dir, "documents"), Spelling())


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 100-byte strings that occur earlier."""
    prepare(spark)
    return digests(table(spark, sf_dir, "documents"), ByteRepeats(window=100))


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_pitman_yor_scores, op2_url_filter, op3_wordpiece_counts, op4_exact_top_k, op5_toxicity_ordinal, op6_token_id_files, op7_best_fit_packing,
    op8_latent_decontamination, op9_substring_dedup, op10_minhash_near_dedup, op11_importance_resampling, op12_spelling_variants,
    op13_suffix_array_dedup)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_top_k": OP4_SQL, "op9_substring_dedup": OP9_SQL, "op11_importance_resampling": OP11_SQL,
            "op12_spelling_variants": OP12_SQL, "op13_suffix_array_dedup": OP13_SQL}
