"""Priority-input checks: persistence, scores (dictionary and fallback weights), evidence, signal refs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.priority import with_benchmark_context, with_scores
from kpiloom.plans.checks.gold import FIXTURE_PRIORITY, Gold, gold_sql
from kpiloom.plans.fixtures import Inputs
from kpiloom.plans.registry import register, rounded

SCORE_COLS = ("month", "priority_candidate_id", "asset_name", "metric_name", "health_status",
              "severity_score", "persistence_months", "persistence_score", "peer_gap_score",
              "commercial_weight_score", "category")
SCORE_SQL = """
select month, priority_candidate_id, asset_name, metric_name, health_status, severity_score,
       persistence_months, persistence_score, peer_gap_score, commercial_weight_score, category from PA
"""


@register("persistence", gold_sql() + """
select month, asset_name, metric_name, is_active, persistence_months,
       least(1.0::double, cast(persistence_months as double) / 3.0::double) as persistence_score from pp
""")
def q_persistence(spark: SparkSession, sf: str) -> DataFrame:
    g = Gold(Inputs(spark, sf))
    df = with_scores(with_benchmark_context(g.health, g.bench), FIXTURE_PRIORITY)
    return df.select("month", "asset_name", "metric_name", "is_active", "persistence_months", "persistence_score")


@register("priority_scores", gold_sql() + SCORE_SQL)
def q_priority_scores(spark: SparkSession, sf: str) -> DataFrame:
    return Gold(Inputs(spark, sf)).scored().select(*SCORE_COLS)


@register("priority_scores_fallback", gold_sql(fallback=True) + SCORE_SQL)
def q_priority_scores_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return Gold(Inputs(spark, sf), with_dictionary=False).scored().select(*SCORE_COLS)


@register("priority_evidence", gold_sql() + """
select month, priority_candidate_id, asset_name, metric_name, n_support as supporting_count,
       support_names as supporting_metrics, support_review_count as supporting_review_count,
       support_max_value as supporting_max_value,
       supporting_evidence_score, peer_rank, peer_club_count, peer_median, peer_leader_value,
       gap_to_peer_median, gap_to_leader from PE
""")
def q_priority_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Nested evidence, checked through per-row digests (count, sorted names, review count, max) and the
    flattened peer context, so the check itself never materialises metric pairs."""
    df = Gold(Inputs(spark, sf)).inputs()
    rows = F.col("supporting_metric_rows")
    return df.select(
        "month", "priority_candidate_id", "asset_name", "metric_name",
        F.size(rows).alias("supporting_count"),
        F.array_join(F.transform(rows, lambda x: x["metric_name"]), ",").alias("supporting_metrics"),
        F.size(F.filter(rows, lambda x: x["health_status"] == "review")).alias("supporting_review_count"),
        F.array_max(F.transform(rows, lambda x: x["metric_value"])).alias("supporting_max_value"),
        "supporting_evidence_score",
        *[F.col(f"peer_context.{c}").alias(c) for c in ("peer_rank", "peer_club_count", "peer_median",
                                                         "peer_leader_value", "gap_to_peer_median",
                                                         "gap_to_leader")],
    )


@register("priority_signal_refs_flat", gold_sql() + """
select PA.month, PA.asset_name, PA.metric_name, 'source' as signal_role, SG.source_asset, SG.source_metric,
       SG.target_asset, SG.target_metric, SG.lag_months, round(SG.strength_score, 9) as strength_score
from PA join SG on PA.asset_name = SG.source_asset and PA.metric_name = SG.source_metric
union all
select PA.month, PA.asset_name, PA.metric_name, 'target', SG.source_asset, SG.source_metric,
       SG.target_asset, SG.target_metric, SG.lag_months, round(SG.strength_score, 9)
from PA join SG on PA.asset_name = SG.target_asset and PA.metric_name = SG.target_metric
""")
def q_priority_signal_refs_flat(spark: SparkSession, sf: str) -> DataFrame:
    df = Gold(Inputs(spark, sf)).inputs()
    refs = df.select("month", "asset_name", "metric_name", F.explode("linked_signal_refs").alias("r"))
    out = refs.select("month", "asset_name", "metric_name", "r.signal_role", "r.source_asset", "r.source_metric",
                      "r.target_asset", "r.target_metric", "r.lag_months", "r.strength_score")
    return rounded(out, "strength_score")
