"""Leading-indicator signal discovery (SIG: AGG3-4, AGG11, JN10, WIN10, CLS11, SRT3).

Does ``source(t)`` predict ``target(t + lag)``? For every configured (candidate, target, lag) the
Pearson correlation of aligned monthly values is computed; strong, well-supported pairs become
signals.

Shift semantics: months are positions in the list of *distinct months of the whole fact* (one
row per month, as in a month x feature pivot), so ``lag`` steps over that list, not the calendar.

Plan: one Spark job, no driver loop.
* the distinct-month list is tiny (one row per calendar month) and is the only data ever ordered
  without a partition key; it is numbered, and broadcast behind a size check;
* the (candidate, target, lag) list is a parameter table, broadcast behind a size check;
* only the configured series are aggregated (broadcast semi-join before the shuffle); the month
  list alone is taken from the whole fact;
* series rows meet pairs by an equi-join on (pair, position + lag = position); no range join,
  no cross join, no pivot;
* count and correlation are partial aggregates per pair, so a long series never lands whole in
  one task; the global top-k is a bounded ``TakeOrderedAndProject``.

The fact is read in two branches (its month column, and the configured series), so pass a
persisted or checkpointed fact (as the medallion run does), not an expensive lazy derivation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.config import SIGNAL_CANDIDATES, SIGNAL_TARGETS, SignalConfig
from kpiloom.functions import pearson
from kpiloom.functions.expressions import sized_broadcast
from kpiloom.sources.config_json import literal_rows

SIGNAL_COLUMNS = (
    "source_asset", "source_metric", "target_asset", "target_metric", "lag_months",
    "relationship_direction", "strength_score", "validation_status", "business_interpretation",
    "last_validated_month",
)
SIGNAL_SCHEMA = ("source_asset string, source_metric string, target_asset string, target_metric string, "
                 "lag_months int, relationship_direction string, strength_score double, "
                 "validation_status string, business_interpretation string, last_validated_month date")
PAIR_SCHEMA = ("source_ord int, source_asset string, source_metric string, template string, "
               "target_ord int, target_asset string, target_metric string, lag_months int")
PAIR_COLS = ("source_asset", "source_metric", "target_asset", "target_metric", "lag_months")


def feature_key(asset: str = "asset_name", metric: str = "metric_name"):
    return F.concat_ws("_", F.col(asset), F.col(metric))


def metric_pivot(fact: DataFrame, features: Sequence[tuple[str, str]]) -> DataFrame:
    """AGG3: month x feature table (max value per cell) for an explicit feature list."""
    values = [f"{a}_{m}" for a, m in features]
    keyed = fact.withColumn("feature_key", feature_key())
    return keyed.groupBy("month").pivot("feature_key", values).agg(F.max("metric_value"))


def month_positions(fact: DataFrame) -> DataFrame:
    """Distinct months numbered 1..n in order, with the last month (AGG4) on every row.

    Only the distinct-month list is ordered globally; it holds one row per calendar month.
    """
    months = fact.select("month").distinct()
    return months.select(
        "month",
        F.row_number().over(Window.orderBy("month")).alias("pos"),
        F.max("month").over(Window.partitionBy()).alias("last_month"),
    )


def pair_table(spark: SparkSession, candidates: Sequence[tuple[str, str, str]],
               targets: Sequence[tuple[str, str]], lags: Sequence[int]) -> DataFrame:
    """All (candidate, target, lag) combinations as a small parameter table."""
    rows = [(ci, ca, cm, tmpl, ti, ta, tm, int(lag))
            for ci, (ca, cm, tmpl) in enumerate(candidates)
            for ti, (ta, tm) in enumerate(targets)
            for lag in lags]
    return literal_rows(spark, rows, PAIR_SCHEMA)


def lag_correlations(fact: DataFrame, candidates: Sequence[tuple[str, str, str]] = SIGNAL_CANDIDATES,
                     targets: Sequence[tuple[str, str]] = SIGNAL_TARGETS,
                     lags: Sequence[int] = SignalConfig().lags) -> DataFrame:
    """JN10 + AGG11: per (candidate, target, lag): aligned pair count and Pearson correlation."""
    spark = fact.sparkSession
    pairs = sized_broadcast(pair_table(spark, candidates, targets, lags))
    # One row per distinct month of the fact; broadcast only behind the size check.
    pos = sized_broadcast(month_positions(fact))
    # Only the configured series are shuffled: a broadcast semi-join on their keys runs map-side.
    keys = [(a, m) for a, m, _ in candidates] + list(targets)
    wanted = sized_broadcast(literal_rows(spark, sorted(set(keys)), "asset_name string, metric_name string"))
    series = (fact.join(wanted, ["asset_name", "metric_name"], "left_semi")
                  .groupBy("month", "asset_name", "metric_name").agg(F.max("metric_value").alias("v"))
                  .join(pos, "month"))
    src = series.join(pairs, (F.col("asset_name") == F.col("source_asset"))
                      & (F.col("metric_name") == F.col("source_metric"))).select(
        "source_ord", "target_ord", *PAIR_COLS, "template", "last_month",
        (F.col("pos") + F.col("lag_months")).alias("at"), F.col("v").alias("x"))
    tkeys = sized_broadcast(pair_table(spark, candidates, targets, lags)
                            .select("target_asset", "target_metric").distinct())
    tgt = series.join(tkeys, (F.col("asset_name") == F.col("target_asset"))
                      & (F.col("metric_name") == F.col("target_metric"))).select(
        "target_asset", "target_metric", F.col("pos").alias("at"), F.col("v").alias("y"))
    aligned = src.join(tgt, ["target_asset", "target_metric", "at"])
    # A pair counts only with both values: the count and all sums then run over the same rows.
    present = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("x", "y")]
    aligned = aligned.filter(present[0] & present[1])
    return aligned.groupBy("source_ord", "target_ord", *PAIR_COLS, "template").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        pearson("x", "y").alias("strength_score"),
        F.max("last_month").alias("last_validated_month"),
    )


def discover_signals(fact: DataFrame, candidates: Sequence[tuple[str, str, str]] = SIGNAL_CANDIDATES,
                     targets: Sequence[tuple[str, str]] = SIGNAL_TARGETS,
                     cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """SIG: strongest validated lagged relationships (at most ``cfg.top_k`` rows).

    ``last_validated_month`` is the last month of the whole fact, as in the monitored pipeline;
    it is carried on the month list, so no extra global aggregate or cross join is needed.
    """
    corr = lag_correlations(fact, candidates, targets, cfg.lags)
    s = F.col("strength_score")
    strong = corr.filter((F.col("n_pairs") > cfg.min_pairs) & s.isNotNull() & ~F.isnan(s)
                         & (F.abs(s) > cfg.min_abs_corr))
    top = strong.orderBy(F.abs(s).desc(), "source_ord", "target_ord", "lag_months").limit(cfg.top_k)
    return top.select(
        *PAIR_COLS[:4], F.col("lag_months").cast("int").alias("lag_months"),
        F.when(s > 0, F.lit("positive")).otherwise(F.lit("negative")).alias("relationship_direction"),
        s.alias("strength_score"),
        F.lit("active").alias("validation_status"),
        F.replace(F.col("template"), F.lit("{}"),
                  F.concat_ws(" ", "target_asset", "target_metric")).alias("business_interpretation"),
        "last_validated_month",
    )


def empty_signals(spark: SparkSession) -> DataFrame:
    """Typed empty signal table (SRC7)."""
    return spark.createDataFrame([], SIGNAL_SCHEMA)
