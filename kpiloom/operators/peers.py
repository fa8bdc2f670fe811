"""Peer benchmark (PEER: PRJ7, PRJ14, AGG1-2, JN1-3, WIN7-8, CLS10, SET2-3).

For every subject row (month, asset, metric) with enough peers: the peer median, mean and leader,
the subject's rank among peers + subject (1 = best, ties share a rank), signed gaps (positive =
ahead) and their 12-row changes.

Plan: a key that holds a third of all peer rows must not land in one task, so no raw peer row is
shuffled by the keys alone. The statistics are partial aggregates of the peers, combined in every
task before their shuffle; clubs are counted in two levels, by (key, club) and then by key.

The rank is ``1 + count(peers strictly better)``, which is ``rank()`` for one subject row per key but needs
no sort. Peers are counted by (key, value): equal values meet in their task, different ones are
dealt over all tasks. Over these counts lies a histogram per key, whose bins are narrow ranges of values
(``PeerConfig.bins_per_doubling``, so the bins fit any scale). Bins beyond the subject's count as a whole;
only the values in the subject's own bin are compared with it, joined by (key, bin). So a key takes as many
tasks as it has values, and what is compared is a small part of it. A repeated subject key counts as one
row with its largest value. The 12-row change is a window on (asset, metric) over the aggregated rows
(one row per month per series).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.config import SOCIAL_MEASURES, PeerConfig
from kpiloom.functions import split_mean
from kpiloom.operators.health import with_polarity
from kpiloom.operators.normalize import unpivot_to_fact

KEYS = ("month", "asset_name", "metric_name")
BENCH_COLUMNS = (
    "month", "asset_name", "metric_name", "subject_value",
    "peer_median", "peer_mean", "peer_leader_value",
    "subject_rank", "club_count", "gap_to_peer_median",
    "gap_to_leader", "rank_change_12m", "gap_change_12m",
)


def split_extra_source(wide: DataFrame, subject_id: str, asset_name: str, measures: Sequence[str],
                       club_column: str = "club_name") -> tuple[DataFrame, DataFrame]:
    """Unpivot an optional wide peer source and split it into subject and peer rows (PRJ7)."""
    fact = unpivot_to_fact(wide.select("month", club_column, *measures), ("month", club_column), measures)
    fact = fact.withColumn("asset_name", F.lit(asset_name))
    is_subject = F.col(club_column) == subject_id
    subj = fact.filter(is_subject).select(*KEYS, "metric_value")
    peers = fact.filter(~is_subject).select(*KEYS, F.col("metric_value").alias("peer_value"),
                                            F.col(club_column).alias("club"))
    return subj, peers


TOP_BIN, ZERO_SHIFT = 1 << 20, 1 << 19


def value_bin(x: Column, per_doubling: int) -> Column:
    """Bin of a value, ascending with it: equal steps of its logarithm on both sides of zero; NaN is in the last."""
    step = F.floor(F.least(F.log2(F.abs(x)) * per_doubling, F.lit(float(ZERO_SHIFT)))).cast("long") + ZERO_SHIFT
    return F.when(x.isNull(), F.lit(None)).when(F.isnan(x), TOP_BIN + 1).when(x == 0, 0).when(x > 0, step).otherwise(-step)


def ahead(subject: DataFrame, peers: DataFrame, cfg: PeerConfig = PeerConfig()) -> DataFrame:
    """WIN7: rows (keys, ahead) that add up to the number of peers strictly better than ``subject(keys, subject_value, polarity)``."""
    values = peers.groupBy(*KEYS, "peer_value").agg(F.count(F.lit(1)).alias("ahead")).withColumn("bin", value_bin(F.col("peer_value"), cfg.bins_per_doubling))
    mine = subject.withColumn("own_bin", value_bin(F.col("subject_value"), cfg.bins_per_doubling))
    # NaN is above everything, whatever the polarity.
    above = (F.col("bin") != F.col("own_bin")) & ((F.col("bin") > TOP_BIN) | ((F.col("bin") - F.col("own_bin")) * F.col("polarity") > 0))
    better = (F.col("peer_value") * F.col("polarity")) > (F.col("subject_value") * F.col("polarity"))
    histogram = values.groupBy(*KEYS, "bin").agg(F.sum("ahead").alias("ahead"))
    inside = values.join(mine.withColumnRenamed("own_bin", "bin"), [*KEYS, "bin"]).where(better)
    return histogram.join(mine, list(KEYS)).where(above).select(*KEYS, "ahead").unionByName(inside.select(*KEYS, "ahead"))


def peer_stats(subject: DataFrame, peers: DataFrame, metric_dim: DataFrame | None = None,
               cfg: PeerConfig = PeerConfig()) -> DataFrame:
    """AGG1-2 + WIN7: one row per benchmarked subject key with stats, rank and polarity.

    The parts have a few rows per key; they are stacked and meet in one aggregation instead of joins.
    """
    mine = with_polarity(subject.groupBy(*KEYS).agg(F.max("metric_value").alias("subject_value")), metric_dim, cfg.default_polarity)
    pe = peers.select(*KEYS, "peer_value", "club")
    stats = pe.groupBy(*KEYS).agg(
        F.percentile_approx("peer_value", 0.5, cfg.median_accuracy).alias("peer_median"),
        split_mean(F.col("peer_value")).alias("peer_mean"),
        F.max("peer_value").alias("peer_max_value"),
        F.min("peer_value").alias("peer_min_value"),
    )
    clubs = pe.groupBy(*KEYS, "club").agg(F.count("*").alias("rows")).groupBy(*KEYS).agg(F.count("club").alias("club_count"))
    parts = [stats, clubs, ahead(mine, pe, cfg), mine]
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    one = ("peer_median", "peer_mean", "peer_max_value", "peer_min_value", "club_count", "subject_value", "polarity")
    met = stacked.groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in one], (F.coalesce(F.sum("ahead"), F.lit(0)) + 1).cast("int").alias("subject_rank"))
    # Only the subject's rows have a polarity. A NULL in the keys meets nothing.
    known = F.col("month").isNotNull() & F.col("asset_name").isNotNull() & F.col("metric_name").isNotNull()
    return met.where(F.col("polarity").isNotNull() & (F.col("club_count") >= cfg.min_clubs) & known).select(
        *KEYS, "peer_median", "peer_mean", "peer_max_value", "peer_min_value", "club_count", "subject_rank", "subject_value", "polarity")


def peer_rank_gap(stats: DataFrame) -> DataFrame:
    """CLS10 + PRJ14: leader by polarity and signed gaps."""
    pol = F.col("polarity")
    leader = F.when(pol == -1, F.col("peer_min_value")).otherwise(F.col("peer_max_value"))
    return stats.withColumn("peer_leader_value", leader).withColumns({
        "gap_to_peer_median": pol * (F.col("subject_value") - F.col("peer_median")),
        "gap_to_leader": pol * (F.col("subject_value") - F.col("peer_leader_value")),
    })


def with_changes(df: DataFrame, lag: int = 12) -> DataFrame:
    """WIN8: rank and median-gap change against ``lag`` rows earlier (positive rank change = better)."""
    w = Window.partitionBy("asset_name", "metric_name").orderBy("month")
    return df.withColumns({
        "rank_change_12m": F.lag("subject_rank", lag).over(w) - F.col("subject_rank"),
        "gap_change_12m": F.col("gap_to_peer_median") - F.lag("gap_to_peer_median", lag).over(w),
    })


def peer_benchmark(subject: DataFrame, peers: DataFrame, metric_dim: DataFrame | None = None,
                   extra: DataFrame | None = None, extra_subject: str | None = None,
                   extra_asset: str = "social_media", extra_measures: Sequence[str] = SOCIAL_MEASURES,
                   cfg: PeerConfig = PeerConfig()) -> DataFrame:
    """PEER: subject fact + peer fact (+ optional wide extra source) -> benchmark contract.

    ``subject``: (month, asset_name, metric_name, metric_value);
    ``peers``: (month, asset_name, metric_name, peer_value, club).
    ``extra`` is used only when given (SRC4); its subject rows are those whose club equals
    ``extra_subject`` (SET2).
    """
    subj = subject.select(*KEYS, "metric_value")
    pe = peers.select(*KEYS, "peer_value", "club")
    if extra is not None:
        if extra_subject is None:
            raise ValueError("an extra source needs the subject's club id (extra_subject)")
        s2, p2 = split_extra_source(extra, extra_subject, extra_asset, extra_measures)
        subj = subj.unionByName(s2)
        pe = pe.unionByName(p2)
    bench = with_changes(peer_rank_gap(peer_stats(subj, pe, metric_dim, cfg)), cfg.change_lag)
    return bench.select(*BENCH_COLUMNS)
