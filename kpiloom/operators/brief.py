"""Monthly brief inputs (BRF: PRJ18, PRJ20, WIN12-13, SRT2, SRT4, AGG5-7, JN9).

Per month of the health table: the top priorities, the top anomalies, the strongest signals and
two summaries, as JSON texts with deterministic empty defaults.

Plan: every part is reduced to one row per month first (top-k windows keep k rows per month;
summaries are partial aggregates), so the final five left joins on ``month`` join tiny inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.config import STATUS_GOOD, STATUS_REVIEW, STATUS_STABLE, BriefConfig
from kpiloom.functions.json_text import Many, Record, json_text
from kpiloom.operators.contracts import BENCHMARK_SUMMARY, HEALTH_SUMMARY, TOP_ANOMALY, TOP_PRIORITY, TOP_SIGNAL

BRIEF_COLUMNS = ("month", "top_priority_ids_json", "top_anomalies_json", "strongest_signal_ids_json",
                 "benchmark_summary_json", "health_summary_json")


def item_columns(item: Record, digits: int) -> list:
    """The columns that an item needs, numbers rounded."""
    return [F.round(v.source, digits).alias(v.source) if v.kind == "number" else F.col(v.source) for v in item.fields.values()]


def top_priority_items(board: DataFrame, cfg: BriefConfig = BriefConfig()) -> DataFrame:
    """SRT2: board rows with a stored rank within the top n."""
    return board.filter(F.col("priority_rank") <= cfg.top_priorities).select(
        "month", *item_columns(TOP_PRIORITY, cfg.digits))


def top_anomaly_items(health: DataFrame, cfg: BriefConfig = BriefConfig()) -> DataFrame:
    """WIN12: top ``review`` rows per month by absolute deviation (ties: asset, metric)."""
    w = Window.partitionBy("month").orderBy(F.abs("deviation_from_rolling_avg").desc(), "asset_name",
                                            "metric_name")
    ranked = health.filter(F.col("health_status") == STATUS_REVIEW).withColumn("anomaly_rank", F.row_number().over(w))
    return ranked.filter(F.col("anomaly_rank") <= cfg.top_anomalies).select(
        "month", *item_columns(TOP_ANOMALY, cfg.digits))


def signal_id():
    return F.concat_ws("__", "source_asset", "source_metric", "target_asset", "target_metric",
                       F.col("lag_months").cast("string"))


def top_signal_items(signals: DataFrame, cfg: BriefConfig = BriefConfig()) -> DataFrame:
    """WIN13: strongest active signals per validated month (ties: signal id)."""
    rows = signals.filter(F.col("validation_status") == "active").withColumn("signal_id", signal_id())
    w = Window.partitionBy("last_validated_month").orderBy(F.abs("strength_score").desc(), "signal_id")
    ranked = rows.withColumn("signal_rank", F.row_number().over(w)).filter(F.col("signal_rank") <= cfg.top_signals)
    return ranked.select(
        F.col("last_validated_month").alias("month"), *item_columns(TOP_SIGNAL, cfg.digits))


def benchmark_summary(bench: DataFrame, cfg: BriefConfig = BriefConfig()) -> DataFrame:
    """AGG6-7 over the benchmark rows of each month."""
    return bench.groupBy("month").agg(
        F.count(F.lit(1)).alias("benchmarked_metric_count"),
        F.count_if(F.col("subject_rank") >= cfg.underperformance_rank).alias("benchmark_underperformance_count"),
        F.round(F.avg("gap_to_peer_median"), cfg.digits).alias("avg_gap_to_peer_median"),
        F.round(F.min("gap_to_peer_median"), cfg.digits).alias("worst_gap_to_peer_median"))


def health_summary(health: DataFrame, cfg: BriefConfig = BriefConfig()) -> DataFrame:
    """AGG6-7 over the health rows of each month."""
    hs = F.col("health_status")
    return health.groupBy("month").agg(
        F.count(F.lit(1)).alias("metric_count"),
        F.count_if(hs == STATUS_GOOD).alias("good_count"),
        F.count_if(hs == STATUS_REVIEW).alias("review_count"),
        F.count_if(hs == STATUS_STABLE).alias("stable_count"),
        F.round(F.avg(F.abs("deviation_from_rolling_avg")), cfg.digits).alias("avg_abs_deviation"))


def json_list(items: DataFrame, item: Record, out: str) -> DataFrame:
    """The items of each month in the order of their rank, as one canonical JSON text (SRT4, PRJ20)."""
    order = sorted(item.sources(), key=lambda c: not c.endswith("_rank"))
    lists = items.groupBy("month").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("items"))
    return lists.select("month", json_text(Many("items", item)).alias(out))


def json_record(rows: DataFrame, record: Record, out: str) -> DataFrame:
    return rows.select("month", json_text(record).alias(out))


def brief_inputs(board: DataFrame, health: DataFrame, bench: DataFrame, signals: DataFrame | None = None,
                 cfg: BriefConfig = BriefConfig()) -> DataFrame:
    """BRF: one row per health month with five JSON payloads ('[]' / '{}' when empty)."""
    if signals is None:
        from kpiloom.operators.signals import empty_signals
        signals = empty_signals(health.sparkSession)
    # The health summary has one row per health month: it is the spine.
    out = json_record(health_summary(health, cfg), HEALTH_SUMMARY, "health_summary_json")
    for part in (json_list(top_priority_items(board, cfg), TOP_PRIORITY, "top_priority_ids_json"),
                 json_list(top_anomaly_items(health, cfg), TOP_ANOMALY, "top_anomalies_json"),
                 json_list(top_signal_items(signals, cfg), TOP_SIGNAL, "strongest_signal_ids_json"),
                 json_record(benchmark_summary(bench, cfg), BENCHMARK_SUMMARY, "benchmark_summary_json")):
        out = out.join(part, "month", "left")
    empty = {c: "{}" if "summary" in c else "[]" for c in BRIEF_COLUMNS if c != "month"}
    return out.select("month", *[F.coalesce(c, F.lit(e)).alias(c) for c, e in empty.items()])
