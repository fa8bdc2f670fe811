"""Spelling variants by permuterm rotations, with DataFrame functions only.

Words are counted over whole texts. Every word is marked with a terminator and rotated. A rotation ends
with one character; what stands before it is the word with that character skipped, cut open there. So

* two words that differ by a replacement share such a prefix and end with different characters;
* a word that lacks the character has the prefix itself as a rotation, without a last character.

Spark sorts the rotations by prefix, and each prefix is one group to scan. Its members differ in the last
character, so a group is never larger than the alphabet (91 for the default letters), however many words
there are; neighbours are counted and the best one is kept, no pairs are listed. A replacement meets its
word in one group; an insertion into a run of equal letters would meet it once for each place, and counts
at the first.

Forms point to a word at least ``times`` as frequent, so a chain of them has at most log(most frequent
word) links; roots follow from doubling the links that many times.

Defined cases: null and empty texts have no words; rows with a null id count their words unchanged;
rows that repeat count again; very long texts are read whole; ties in n go to the smaller word in code-point
order; an empty table gives no rows; extra columns are not read. ``neighbours`` needs letters that are
not the terminator, and it never meets one, because words consist of ``letters``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.spark import checkpointed, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"


@dataclass(frozen=True)
class Spelling:
    letters: str = r"[A-Za-zÀ-ÿ]"
    min_length: int = 7         # code points
    min_count: int = 2
    times: int = 10             # a form is at least this many times as frequent
    typo_every: int = 31        # one of so many (document, run) pairs loses a character; 0: none


def with_typo(name: Column, run: Column, every: int) -> Column:
    """The run, without one of its code points where the CRC of ``id:run`` says so."""
    if not every:
        return run
    h = F.crc32(F.concat(name.cast("string"), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + F.lit(2), F.char_length(run)))
    return F.when(F.coalesce(h % every == 0, F.lit(False)), cut).otherwise(run)


def word_counts(docs: DataFrame, cfg: Spelling, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over whole texts."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(cfg.letters + "+"), F.lit(0))
    # One code point may be lost, no more: shorter runs can be left out at once.
    long_enough = F.filter(F.transform(runs, lambda r: F.translate(r, UPPER, LOWER)), lambda r: F.char_length(r) >= cfg.min_length)
    words = docs.select(F.col(id_col).alias("id"), F.explode(long_enough).alias("run")).select(with_typo(F.col("id"), F.col("run"), cfg.typo_every).alias("word"))
    return (words.where(F.char_length("word") >= cfg.min_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= cfg.min_count))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, last, word, n, before): every rotation without its last character, and the word's own with none.

    ``before`` is the character in front of the place, '' at the start.
    """
    w, size = F.col("word"), F.char_length("word")
    opened = lambda i, skip: F.concat(F.substring(w, i + F.lit(1 + skip), size), F.lit(END), F.substring(w, F.lit(1), i))
    front = lambda i: F.when(i > 0, F.substring(w, i, F.lit(1))).otherwise(F.lit(""))
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        opened(i, 1).alias("prefix"), F.substring(w, i + F.lit(1), F.lit(1)).alias("last"), front(i).alias("before")))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        opened(i, 0).alias("prefix"), F.lit(None).cast("string").alias("last"), front(i).alias("before")))
    return words.select("word", "n", F.explode(F.concat(skipped, whole)).alias("r")).select("word", "n", "r.*")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): how many words differ in one code point, and the most frequent of them."""
    group = Window.partitionBy("prefix")
    scan = group.orderBy(F.col("n").desc(), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = F.struct("n", "word")
    first, second = F.first(one).over(scan), F.nth_value(one, 2).over(scan)
    edited = F.col("last").isNotNull()
    place = edited & (F.col("last") != F.col("before"))     # the first place of a run of equal letters
    seen = rotations(words).select(
        "word", edited.alias("edited"), place.alias("place"),
        F.count("*").over(group).alias("size"), F.count_if(edited).over(group).alias("edits"), F.count_if(place).over(group).alias("places"),
        F.when(first["word"] == F.col("word"), second).otherwise(first).alias("best"))
    base = F.col("size") > F.col("edits")
    near = F.when(F.col("edited"), F.col("edits") - 1 + F.when(base & F.col("place"), 1).otherwise(0)).otherwise(F.col("places"))
    # Largest n, then the smallest word.
    met = seen.where(F.col("size") > 1).select("word", near.alias("near"), "best")
    per_n = met.groupBy("word", F.col("best.n").alias("near_n")).agg(F.sum("near").alias("near"), F.min("best.word").alias("near_word"))
    return per_n.groupBy("word").agg(F.sum("near").alias("n_near"), F.max(F.struct("near_n", "near_word")).alias("b")).select(
        "word", "n_near", F.col("b.near_word").alias("near"), F.col("b.near_n").alias("near_n"))


def roots(forms: DataFrame, most: int, times: int) -> DataFrame:
    """(word, root) of ``forms(word, form)``; a chain multiplies n by ``times`` at each link, up to ``most``."""
    links = max(1, math.ceil(math.log(max(most, 2)) / math.log(times)) + 1) if times > 1 else most
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(links)))):
        step = found.select(F.col("word").alias("mid"), F.col("root").alias("next"))
        found = checkpointed(found.join(step, found["root"] == step["mid"], "left").select("word", F.coalesce("next", "root").alias("root")))
    return found


def variants(docs: DataFrame, cfg: Spelling = Spelling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: word, form, root, n, n_near and form_n."""
    words = materialise(word_counts(docs, cfg, id_col, text_col), "words")
    fits = F.col("near_n") >= F.lit(cfg.times) * F.col("n")
    found = words.join(neighbours(words), "word", "left")
    table = materialise(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")), "forms")
    most = table.agg(F.max("n")).first()[0] or 0
    ends = roots(table.where("form is not null"), most, cfg.times)
    return (table.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
