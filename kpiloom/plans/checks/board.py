"""Priority-board checks: flat board columns, the JSON payload as text and parsed back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from kpiloom.config import BoardConfig
from kpiloom.operators.board import BOARD_COLUMNS, priority_board, ranked_priorities
from kpiloom.functions.json_text import json_type
from kpiloom.operators.contracts import EVIDENCE, SIGNAL_REFERENCE, SUPPORTING_ROW
from kpiloom.plans.checks.gold import Gold, gold_sql
from kpiloom.plans.fixtures import Inputs
from kpiloom.plans.oracle import list_sql, record_sql
from kpiloom.plans.registry import register
from kpiloom.session import scratch_path
from kpiloom.sources.config_json import literal_rows, weights_from_json

FLAT = [c for c in BOARD_COLUMNS if c != "supporting_metrics_json"]


@register("priority_board", gold_sql(board=True) + """
select month, priority_id, priority_title, priority_category, priority_score,
       priority_rank, asset_name, primary_metric, summary_text, why_it_matters, suggested_next_investigation
from BD
""")
def q_priority_board(spark: SparkSession, sf: str) -> DataFrame:
    g = Gold(Inputs(spark, sf))
    return ranked_priorities(g.ranked_from(), signals=g.signals).select(*FLAT)


# The signals that name a row, once per role, and the other active rows of its month and asset.
EVIDENCE_CTE = f"""
, refs as (
  select asset_name, metric_name, {{refs}} as linked from (
    select distinct source_asset as asset_name, source_metric as metric_name, 'source' as signal_role, * from SG
    union select distinct target_asset, target_metric, 'target', * from SG) r
  group by asset_name, metric_name),
others as (
  select a.month, a.asset_name, a.metric_name, {{rows}} as supporting
  from BR a join PA o on a.month = o.month and a.asset_name = o.asset_name and a.metric_name <> o.metric_name group by 1, 2, 3),
payload as (
  select BR.month, BR.priority_candidate_id as priority_id, {{evidence}} as supporting_metrics_json
  from BR left join refs using (asset_name, metric_name) left join others using (month, asset_name, metric_name))
""".format(
    refs=list_sql(record_sql(SIGNAL_REFERENCE, "r.{}"), "signal_role, source_asset, source_metric, target_asset, target_metric, lag_months"),
    rows=list_sql(record_sql(SUPPORTING_ROW, "o.{}"), "o.metric_name"),
    evidence=record_sql(
        EVIDENCE, "BR.{}",
        persistence_inputs="""'{"active_months_in_last_3":' || BR.persistence_months || ',"lookback_months":3}'""",
        peer_context="case when BR.peer_rank is not null then " + record_sql(EVIDENCE.fields["peer_context"], "BR.{}") + " end",
        linked_signal_references="coalesce(refs.linked, '[]')", supporting_metric_rows="coalesce(others.supporting, '[]')"))


@register("priority_board_json", gold_sql(board=True) + EVIDENCE_CTE + """
select BD.*, supporting_metrics_json from BD join payload using (month, priority_id)
""")
def q_priority_board_json(spark: SparkSession, sf: str) -> DataFrame:
    """The whole board, with the evidence as JSON text."""
    g = Gold(Inputs(spark, sf))
    return priority_board(g.ranked_from(), signals=g.signals)


JSON_WEIGHTS = {"severity": 0.1, "persistence": 0.15, "peer_gap": 0.2, "commercial": 0.25, "evidence": 0.3}


def _reweighted(sql: str) -> str:
    """The board's SQL with the weights of ``JSON_WEIGHTS`` in place of the defaults."""
    for column, default, other in (("severity_score", 0.3, 0.1), ("persistence_score", 0.25, 0.15),
                                   ("commercial_weight_score", 0.15, 0.25), ("supporting_evidence_score", 0.1, 0.3)):
        sql = sql.replace(f"({column} * {default}::double)", f"({column} * {other}::double)")
    return sql


@register("board_weights_json", _reweighted(gold_sql(board=True)) + """
select month, priority_id, priority_score, priority_rank from BD
""")
def q_board_weights_json(spark: SparkSession, sf: str) -> DataFrame:
    """The board under scoring weights that are read from a JSON file."""
    path = scratch_path(spark, "scoring_config")
    text = json.dumps({"formula_weights": JSON_WEIGHTS}, indent=2)
    literal_rows(spark, [(text,)], "value string").coalesce(1).write.text(path)
    g = Gold(Inputs(spark, sf))
    cfg = BoardConfig(weights=weights_from_json(spark, path))
    return ranked_priorities(g.ranked_from(), cfg, g.signals).select("month", "priority_id", "priority_score", "priority_rank")


@register("priority_board_json_roundtrip", gold_sql(board=True) + """
select BR.priority_candidate_id as priority_id, BR.priority_rank, round(BR.severity_score, 9) as severity,
       round(BR.persistence_score, 9) as persistence, round(BR.peer_gap_score, 9) as peer_gap,
       round(BR.commercial_weight_score, 9) as commercial_weight, round(BR.supporting_evidence_score, 9) as supporting_evidence,
       BR.health_status, BR.persistence_months as active_months_in_last_3, 3 as lookback_months,
       BR.peer_rank, BR.n_support as supporting_rows,
       (select count(*) from SG where (SG.source_asset = BR.asset_name and SG.source_metric = BR.metric_name)
          or (SG.target_asset = BR.asset_name and SG.target_metric = BR.metric_name)) as linked_signals
from BR
""")
def q_priority_board_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON payload parsed back (``from_json``) and flattened."""
    from pyspark.sql import functions as F

    g = Gold(Inputs(spark, sf))
    board = priority_board(g.ranked_from(), signals=g.signals)
    p = F.from_json("supporting_metrics_json", json_type(EVIDENCE), {"mode": "FAILFAST"})
    out = board.select("priority_id", "priority_rank", p.alias("p")).select(
        "priority_id", "priority_rank", *[F.round(f"p.score_components.{c}", 9).alias(c) for c in EVIDENCE.fields["score_components"].fields], "p.severity_inputs.health_status",
        "p.persistence_inputs.active_months_in_last_3", F.col("p.persistence_inputs.lookback_months").cast("int").alias("lookback_months"),
        F.col("p.peer_context.peer_rank").cast("int").alias("peer_rank"),
        F.size("p.supporting_metric_rows").alias("supporting_rows"),
        F.size("p.linked_signal_references").cast("bigint").alias("linked_signals"))
    return out
