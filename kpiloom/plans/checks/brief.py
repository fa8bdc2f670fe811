"""Monthly-brief checks: the flat items behind each JSON list, the summaries, the JSON texts and what they parse to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators.board import priority_board, ranked_priorities
from kpiloom.operators.brief import (
    benchmark_summary, brief_inputs, health_summary, top_anomaly_items, top_priority_items, top_signal_items,
)
from kpiloom.functions.json_text import Many, json_type
from kpiloom.operators.contracts import BENCHMARK_SUMMARY, HEALTH_SUMMARY, TOP_ANOMALY, TOP_PRIORITY, TOP_SIGNAL
from kpiloom.plans.checks.gold import Gold, gold_sql
from kpiloom.plans.fixtures import Inputs
from kpiloom.plans.oracle import list_sql, record_sql
from kpiloom.plans.registry import register


@register("brief_priorities_flat", gold_sql(board=True) + """
select month, priority_rank, priority_id, priority_title, priority_category, round(priority_score, 4) as priority_score
from BD where priority_rank <= 3
""")
def q_brief_priorities_flat(spark: SparkSession, sf: str) -> DataFrame:
    return top_priority_items(ranked_priorities((g := Gold(Inputs(spark, sf))).ranked_from(), signals=g.signals))


@register("brief_anomalies_flat", gold_sql() + """
select month, anomaly_rank, asset_name, metric_name, round(metric_value, 4) as metric_value,
       round(deviation_from_rolling_avg, 4) as deviation_from_rolling_avg
from (select *, cast(row_number() over (partition by month order by abs(deviation_from_rolling_avg) desc,
                                       asset_name, metric_name) as integer) as anomaly_rank
      from H where health_status = 'review') t
where anomaly_rank <= 3
""")
def q_brief_anomalies_flat(spark: SparkSession, sf: str) -> DataFrame:
    return top_anomaly_items(Gold(Inputs(spark, sf)).health)


@register("brief_signals_flat", gold_sql() + """
select last_validated_month as month, signal_rank, signal_id, source_asset, source_metric, target_asset,
       target_metric, lag_months, relationship_direction, round(strength_score, 4) as strength_score
from (select *, cast(row_number() over (partition by last_validated_month order by abs(strength_score) desc,
                                       signal_id) as integer) as signal_rank
      from (select *, source_asset || '__' || source_metric || '__' || target_asset || '__' || target_metric
                      || '__' || cast(lag_months as varchar) as signal_id from SG) s) t
where signal_rank <= 3
""")
def q_brief_signals_flat(spark: SparkSession, sf: str) -> DataFrame:
    return top_signal_items(Gold(Inputs(spark, sf)).signals)


@register("brief_summaries_flat", gold_sql() + """
, hm as (select distinct month from H),
bsum as (select month, count(*) as benchmarked_metric_count,
                count(*) filter (where subject_rank >= 4) as benchmark_underperformance_count,
                round(avg(gap_to_peer_median), 4) as avg_gap_to_peer_median,
                round(min(gap_to_peer_median), 4) as worst_gap_to_peer_median
         from B group by month),
hsum as (select month, count(*) as metric_count, count(*) filter (where health_status = 'good') as good_count,
                count(*) filter (where health_status = 'review') as review_count,
                count(*) filter (where health_status = 'stable') as stable_count,
                round(avg(abs(deviation_from_rolling_avg)), 4) as avg_abs_deviation
         from H group by month)
select hm.month, benchmarked_metric_count, benchmark_underperformance_count, avg_gap_to_peer_median,
       worst_gap_to_peer_median, metric_count, good_count, review_count, stable_count, avg_abs_deviation
from hm left join bsum on hm.month = bsum.month left join hsum on hm.month = hsum.month
""")
def q_brief_summaries_flat(spark: SparkSession, sf: str) -> DataFrame:
    g = Gold(Inputs(spark, sf))
    return health_summary(g.health).join(benchmark_summary(g.bench), "month", "left")


BRIEF_CTE = """
, hm as (select distinct month from H),
tp as (select month, {priorities} as top_priority_ids_json from (
         select *exclude(priority_score), round(priority_score, 4) as priority_score from BD where priority_rank <= 3) b group by month),
ta as (select month, {anomalies} as top_anomalies_json from (
         select month, asset_name, metric_name, round(metric_value, 4) as metric_value,
                round(deviation_from_rolling_avg, 4) as deviation_from_rolling_avg,
                row_number() over (partition by month order by abs(deviation_from_rolling_avg) desc, asset_name, metric_name) as anomaly_rank
         from H where health_status = 'review') x where anomaly_rank <= 3 group by month),
ts as (select month, {signals} as strongest_signal_ids_json from (
         select *exclude(strength_score), round(strength_score, 4) as strength_score, last_validated_month as month,
                row_number() over (partition by last_validated_month order by abs(strength_score) desc, signal_id) as signal_rank
         from (select *, source_asset || '__' || source_metric || '__' || target_asset || '__' || target_metric
                         || '__' || cast(lag_months as varchar) as signal_id from SG) s) t where signal_rank <= 3 group by month),
bsj as (select month, {benchmark} as benchmark_summary_json from (
         select month, count(*) as benchmarked_metric_count, count(*) filter (where subject_rank >= 4) as benchmark_underperformance_count,
                round(avg(gap_to_peer_median), 4) as avg_gap_to_peer_median, round(min(gap_to_peer_median), 4) as worst_gap_to_peer_median
         from B group by month) b),
hsj as (select month, {health} as health_summary_json from (
         select month, count(*) as metric_count, count(*) filter (where health_status = 'good') as good_count,
                count(*) filter (where health_status = 'review') as review_count, count(*) filter (where health_status = 'stable') as stable_count,
                round(avg(abs(deviation_from_rolling_avg)), 4) as avg_abs_deviation
         from H group by month) h)
""".format(priorities=list_sql(record_sql(TOP_PRIORITY), "priority_rank"), anomalies=list_sql(record_sql(TOP_ANOMALY), "anomaly_rank"),
           signals=list_sql(record_sql(TOP_SIGNAL), "signal_rank"), benchmark=record_sql(BENCHMARK_SUMMARY), health=record_sql(HEALTH_SUMMARY))


@register("brief_inputs_json", gold_sql(board=True) + BRIEF_CTE + """
select hm.month, coalesce(top_priority_ids_json, '[]') as top_priority_ids_json, coalesce(top_anomalies_json, '[]') as top_anomalies_json,
       coalesce(strongest_signal_ids_json, '[]') as strongest_signal_ids_json, coalesce(benchmark_summary_json, '{}') as benchmark_summary_json,
       coalesce(health_summary_json, '{}') as health_summary_json
from hm left join tp using (month) left join ta using (month) left join ts using (month) left join bsj using (month) left join hsj using (month)
""")
def q_brief_inputs_json(spark: SparkSession, sf: str) -> DataFrame:
    """The whole brief: all five JSON texts, every field and the order of the lists."""
    g = Gold(Inputs(spark, sf)).kept()
    return brief_inputs(priority_board(g.ranked_from(), signals=g.signals), g.health, g.bench, g.signals)


@register("brief_inputs_json_roundtrip", gold_sql(board=True) + """
, hm as (select distinct month from H),
tp as (select month, count(*) as n_priorities, min(priority_id) filter (where priority_rank = 1) as first_priority_id
       from BD where priority_rank <= 3 group by month),
ta as (select month, count(*) as n_anomalies from
         (select month, row_number() over (partition by month order by abs(deviation_from_rolling_avg) desc,
                                            asset_name, metric_name) as r
          from H where health_status = 'review') x where r <= 3 group by month),
hs as (select month, count(*) as metric_count, count(*) filter (where health_status = 'review') as review_count
       from H group by month),
sgc as (select last_validated_month as month, count(*) as n_signals from SG group by 1)
select hm.month, coalesce(tp.n_priorities, 0) as n_priorities, tp.first_priority_id,
       coalesce(ta.n_anomalies, 0) as n_anomalies, coalesce(sgc.n_signals, 0) as n_signals,
       hs.metric_count, hs.review_count
from hm left join tp on hm.month = tp.month left join ta on hm.month = ta.month
        left join sgc on hm.month = sgc.month left join hs on hm.month = hs.month
""")
def q_brief_inputs_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The brief's JSON payloads parsed back and summarised per month."""
    from pyspark.sql import functions as F

    g = Gold(Inputs(spark, sf)).kept()
    brief = brief_inputs(priority_board(g.ranked_from(), signals=g.signals), g.health, g.bench, g.signals)
    read = lambda c, part: F.from_json(c, json_type(part), {"mode": "FAILFAST"})
    pri, hs = read("top_priority_ids_json", Many("", TOP_PRIORITY)), read("health_summary_json", HEALTH_SUMMARY)
    return brief.select(
        "month", F.size(pri).cast("bigint").alias("n_priorities"),
        F.get(F.filter(pri, lambda x: x["priority_rank"] == 1), 0)["priority_id"].alias("first_priority_id"),
        F.size(read("top_anomalies_json", Many("", TOP_ANOMALY))).cast("bigint").alias("n_anomalies"),
        F.size(read("strongest_signal_ids_json", Many("", TOP_SIGNAL))).cast("bigint")
        .alias("n_signals"),
        hs["metric_count"].alias("metric_count"), hs["review_count"].alias("review_count"))
