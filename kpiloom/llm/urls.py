"""URL filter: path rules, then naive Bayes over segmented host names and path tokens.

* A rule ``host/path`` fits its host and all subdomains where the url's path starts with the rule's path;
  the longest fitting rule decides.
* Without a rule, the host's labels are cut at characters other than letters and then into words by a
  unigram Viterbi search. Word counts come from all pages: the words of their texts and the parts of
  their hosts that two hosts or more have. An unknown word of n letters has probability 10 / (N * 10^n). Words of any length
  count: longer ones than ``anchor`` letters are looked up by their first ``anchor``.
* A host is an example of a blocked one if one of its words is a ``seed``. A multinomial naive Bayes with
  add-``alpha`` smoothing is counted over all pages from that, and scores host words and path tokens
  (numbers count as one token). Above 0 it blocks, so words that keep company with seeds block as well.

Pages are first grouped by (host, path tokens), so a host with a third of all pages is one row; the
search for words and the model work on distinct hosts and tokens.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule and the prior's
verdict; html that is null has no words; repeated rows and null ids are judged like others; without any
seed host nothing is blocked by the method; hosts and paths of any length are read whole (names are looked up
in pieces of ``piece`` letters); extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.spark import materialise


@dataclass(frozen=True)
class UrlFilter:
    rules: tuple[tuple[str, str], ...] = (("net/", "block"), ("example.net/en/", "allow"),
                                          ("example.com/de/", "block"), ("org/fr/", "allow"))
    seeds: tuple[str, ...] = ("ads", "bet", "bets", "casino", "gambling", "lottery", "pharmacy", "pills",
                              "poker", "porn", "spam", "viagra", "xxx")
    anchor: int = 24            # letters by which words are looked up
    piece: int = 512            # letters of a name that one row looks up
    alpha: float = 1.0


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, cfg: UrlFilter) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(cfg.rules, key=lambda r: len(r[0])):      # longer ones are tested first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def viterbi(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words that make up ``name``; ties take the longer last word."""
    sizes = sorted({len(w) for w in counts}, reverse=True)
    unknown, letter = math.log(10 / total), math.log(10)
    best, back = [0.0], [0]
    lead, origin = 0.0, 0           # the start from which an unknown word is best, wherever it ends
    for end in range(1, len(name) + 1):
        top, at = lead + unknown - end * letter, origin
        for size in sizes:
            n = counts.get(name[end - size:end]) if size <= end else None
            score = best[end - size] + math.log(n / total) if n else -math.inf
            if score > top or (score == top and end - size < at):
                top, at = score, end - size
        best.append(top)
        back.append(at)
        if top + end * letter > lead:
            lead, origin = top + end * letter, end
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def segmented(names: DataFrame, words: DataFrame, cfg: UrlFilter) -> DataFrame:
    """(name, words) for distinct names of letters; ``words(word, n)`` is the dictionary."""
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    named = names.withColumn("id", F.xxhash64("name"))      # names that share it share their words, which does no harm
    pieces = (named.select("id", "name", F.explode(F.expr(f"sequence(0, (length(name) - 1) div {cfg.piece})")).alias("nth"))
              .select("id", F.expr(f"substring(name, cast(nth as int) * {cfg.piece} + 1, {cfg.piece + cfg.anchor - 1})").alias("piece")))
    cut = F.expr(f"flatten(transform(sequence(1, least({cfg.piece}, length(piece))), "
                 f"i -> transform(sequence(1, least({cfg.anchor}, length(piece) - i + 1)), n -> substring(piece, i, n))))")
    parts = pieces.select("id", F.explode(F.array_distinct(cut)).alias("key"))
    known = (parts.join(words.withColumn("key", F.substring("word", 1, cfg.anchor)), "key")
             .groupBy("id").agg(F.collect_list("word").alias("known"), F.collect_list("n").alias("n")))

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, known: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([viterbi(x, {} if k is None else dict(zip(k, c, strict=True)), total)
                          for x, k, c in zip(name, known, n, strict=True)])

    return named.join(known, "id", "left").select("name", split("name", "known", "n").alias("words"))


def judged(pages: DataFrame, cfg: UrlFilter = UrlFilter(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, host, path, rule, verdict, score (log odds of blocking by the method)."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    tokens = F.expr("transform(regexp_extract_all(lower(path), '([a-z]+|[0-9]+)'), x -> if(x rlike '^[0-9]', '<number>', x))")
    rows = rows.withColumn("shape", tokens)
    grouped = materialise(rows.groupBy("host", "shape").agg(F.count("*").alias("pages")), "hosts")
    hosts = grouped.groupBy("host").agg(F.sum("pages").alias("pages"))
    names = materialise(hosts.select("host", "pages", F.explode(F.expr("regexp_extract_all(host, '([a-z]+)')")).alias("name")), "names")

    text = F.regexp_replace(F.col(html_col).cast("string"), r"(?s)<[^>]*>", " ")
    from_text = pages.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"))).alias("word"))
    from_hosts = (names.groupBy(F.col("name").alias("word")).agg(F.count("*").alias("n"), (F.min("host") < F.max("host")).alias("shared"))
                  .where("shared").select("word", "n"))        # a name of one host is no evidence that it is one word
    words = (from_text.groupBy("word").agg(F.count("*").alias("n"))
             .union(from_hosts).groupBy("word").agg(F.sum("n").alias("n")))
    split = segmented(names.select("name").distinct(), materialise(words, "words"), cfg)
    host_words = materialise(names.join(split, "name").select("host", F.explode("words").alias("token")), "host-words")

    # Counts of the two classes over all pages; a host with a seed word is an example of a blocked one.
    seeded = host_words.groupBy("host").agg(F.max(F.col("token").isin(*cfg.seeds).cast("int")).alias("blocked"))
    shape_tokens = F.explode(F.transform("shape", lambda x: F.concat(F.lit("/"), x))).alias("token")
    classed = grouped.join(seeded, "host", "left").withColumn("blocked", F.coalesce("blocked", F.lit(0)))
    by_host = classed.groupBy("host", "blocked").agg(F.sum("pages").alias("pages"))
    by_shape = classed.groupBy("shape", "blocked").agg(F.sum("pages").alias("pages"))
    seen = (by_host.join(host_words, "host").select("token", "blocked", "pages")
            .union(by_shape.select(shape_tokens, "blocked", "pages")))
    count = lambda k: F.sum(F.when(F.col("blocked") == k, F.col("pages")).otherwise(0))
    table = materialise(seen.groupBy("token").agg(count(1).alias("yes"), count(0).alias("no")), "tokens")
    sums = table.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"), F.count("*").alias("kinds")).first()
    prior = by_host.agg(count(1).alias("yes"), count(0).alias("no")).first()
    yes, no, kinds = sums["yes"] or 0, sums["no"] or 0, sums["kinds"]
    base = math.log(((prior["yes"] or 0) + 1) / ((prior["no"] or 0) + 1))
    weight = table.select("token", (F.log((F.col("yes") + cfg.alpha) / F.lit(yes + cfg.alpha * (kinds + 1)))
                                    - F.log((F.col("no") + cfg.alpha) / F.lit(no + cfg.alpha * (kinds + 1)))).alias("w"))
    of_host = host_words.join(weight, "token").groupBy("host").agg(F.sum("w").alias("host_w"))
    shapes = grouped.select("shape").distinct()
    of_shape = (shapes.select("shape", shape_tokens).join(weight, "token")
                .groupBy("shape").agg(F.sum("w").alias("shape_w")))

    rule, verdict = rule_of(F.col("host"), F.col("path"), cfg)
    score = F.lit(base if yes else -math.inf) + F.coalesce("host_w", F.lit(0.0)) + F.coalesce("shape_w", F.lit(0.0))
    scored = rows.join(of_host, "host", "left").join(of_shape, "shape", "left").withColumn("score", score)
    return scored.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
