"""Shared builders for the gold-layer checks: Spark side and the composed oracle CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kpiloom.config import CategoryRules, PriorityConfig
from kpiloom.operators.health import kpi_health
from kpiloom.operators.peers import peer_benchmark
from kpiloom.operators.priority import active_scored, priority_inputs, scored_inputs
from kpiloom.plans.checks.health import HEALTH_ROWS
from kpiloom.plans.checks.peers import BENCH_CTE
from kpiloom.plans.checks.signals import SIGNALS_CTE, fixture_signals
from kpiloom.plans.fixtures import Inputs

# Category parameters for the derived data: every branch of the ladder is reached at sf0.01.
FIXTURE_RULES = CategoryRules(conversion_asset="automobile", growth_patterns=("%customers%", "%order_count%"),
                              engagement_patterns=("%cart%", "%return%"))
FIXTURE_PRIORITY = PriorityConfig(categories=FIXTURE_RULES)


class Gold:
    """Health, benchmark, signals and priority inputs for one data folder (all lazy)."""

    def __init__(self, inp: Inputs, with_dictionary: bool = True):
        self.inp = inp
        inp.shared = True
        s = inp.subject_fact()
        p = inp.peer_fact()
        self.dim = inp.metric_dim()
        self.health = kpi_health(s, self.dim)
        self.bench = peer_benchmark(s, p, self.dim)
        self.signals = fixture_signals(inp)
        self.weights_dim = self.dim if with_dictionary else None

    def kept(self) -> "Gold":
        """Health and benchmark materialised once (one row per series and month): the brief reads each several times."""
        self.health, self.bench = self.health.checkpoint(eager=True), self.bench.checkpoint(eager=True)
        return self

    def ranked_from(self) -> DataFrame:
        """The scores, materialised with the signals: a board reads them for its rows, the shown pairs and the evidence."""
        self.signals = self.signals.checkpoint(eager=True)
        return self.scores().checkpoint(eager=True)

    def scored(self) -> DataFrame:
        return active_scored(self.health, self.bench, self.signals, self.weights_dim, FIXTURE_PRIORITY)

    def scores(self) -> DataFrame:
        return scored_inputs(self.health, self.bench, self.signals, self.weights_dim, FIXTURE_PRIORITY)

    def inputs(self) -> DataFrame:
        return priority_inputs(self.health, self.bench, self.signals, self.weights_dim, FIXTURE_PRIORITY)


WEIGHT_DICT = "coalesce(d.commercial_weight, 0.4::double)"
WEIGHT_FALLBACK = "case when vs.source_asset is not null then 0.8::double else 0.4::double end"
JOIN_DICT = "left join D d on pp.metric_name = d.metric_name"
JOIN_FALLBACK = ("left join (select distinct source_asset, source_metric from SG) vs "
                 "on pp.asset_name = vs.source_asset and pp.metric_name = vs.source_metric")

PRIORITY_CTE = """
, pj as (
  select h.month, h.asset_name, h.metric_name, h.metric_value, h.health_status, h.trend_direction,
         h.deviation_from_rolling_avg, h.seasonal_z_score, b.subject_rank as peer_rank,
         b.club_count as peer_club_count, b.peer_median, b.peer_leader_value, b.gap_to_peer_median, b.gap_to_leader
  from H h left join B b on h.month = b.month and h.asset_name = b.asset_name and h.metric_name = b.metric_name),
psc as (
  select *, case when health_status <> 'stable' then 1 else 0 end as is_active,
         case when health_status <> 'stable' then least(1.0::double, abs(seasonal_z_score) / 2.0::double)
              else 0.0::double end as severity_score,
         case when peer_rank is null then 0.0::double when peer_rank >= 5 then 1.0::double
              when peer_rank = 4 then 0.8::double when peer_rank = 3 then 0.4::double
              else 0.0::double end as peer_gap_score
  from pj),
pp as (
  select *, cast(sum(is_active) over (partition by asset_name, metric_name order by month
                                      rows between 2 preceding and current row) as bigint) as persistence_months
  from psc),
pw as (
  select pp.*, least(1.0::double, cast(persistence_months as double) / 3.0::double) as persistence_score,
         {weight} as commercial_weight_score
  from pp {join}),
PA as (
  select *, case when health_status = 'review' and asset_name = 'automobile' then 'conversion weakness'
                 when health_status = 'review' and (metric_name like '%customers%' or metric_name like '%order_count%')
                      then 'growth risk'
                 when peer_gap_score >= 0.8 then 'benchmark underperformance'
                 when health_status = 'good' and (metric_name like '%cart%' or metric_name like '%return%')
                      then 'engagement opportunity'
                 when health_status = 'review' then 'resilience concern'
                 else 'engagement opportunity' end as category,
         strftime(month, '%Y-%m-%d') || '_' || asset_name || '_' || metric_name as priority_candidate_id
  from pw where is_active = 1),
ev as (
  select a.month, a.asset_name, a.metric_name, cast(count(o.metric_name) as integer) as n_support,
         coalesce(string_agg(o.metric_name, ',' order by o.metric_name), '') as support_names,
         cast(count(o.metric_name) filter (where o.health_status = 'review') as integer) as support_review_count,
         max(o.metric_value) as support_max_value
  from PA a left join PA o on a.month = o.month and a.asset_name = o.asset_name and a.metric_name <> o.metric_name
  group by 1, 2, 3),
PE as (
  select PA.*, least(1.0::double, cast(ev.n_support as double) / 5.0::double) as supporting_evidence_score,
         ev.n_support, ev.support_names, ev.support_review_count, ev.support_max_value
  from PA join ev on PA.month = ev.month and PA.asset_name = ev.asset_name and PA.metric_name = ev.metric_name)
"""
BOARD_CTE = """
, BS as (
  select PE.*, (severity_score * 0.3::double) + (persistence_score * 0.25::double)
               + (peer_gap_score * 0.2::double) + (commercial_weight_score * 0.15::double)
               + (supporting_evidence_score * 0.1::double) as priority_score,
         exists (select 1 from SG where (SG.source_asset = PE.asset_name and SG.source_metric = PE.metric_name)
                 or (SG.target_asset = PE.asset_name and SG.target_metric = PE.metric_name)) as has_signal
  from PE),
BR as (
  select * from (select *, cast(row_number() over (partition by month order by priority_score desc, asset_name,
                                                         metric_name) as integer) as priority_rank from BS) t
  where priority_rank <= 10),
BD as (
  select month, priority_candidate_id as priority_id,
         array_to_string(list_transform(string_split(category, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
           || ' in ' ||
         array_to_string(list_transform(string_split(replace(asset_name, '_', ' '), ' '),
                                        lambda w: upper(w[1]) || lower(w[2:])), ' ') as priority_title,
         category as priority_category, priority_score, priority_rank, asset_name, metric_name as primary_metric,
         case when deviation_from_rolling_avg is null then null
              else metric_name || ' is ' || trend_direction || ' versus prior month with trend deviation '
                   || format('{{:,.4f}}', deviation_from_rolling_avg) || '.' end as summary_text,
         case when has_signal then 'This metric is connected to validated leading indicators and can affect commercial outcomes.'
              when peer_rank is not null then 'This metric has measurable peer benchmark context and a defined competitive gap.'
              else 'This metric is persistently outside stable range and requires operational review.' end
           as why_it_matters,
         case when category like '%conversion%' then 'Investigate funnel drop-off points and recent checkout changes.'
              when category like '%growth%' then 'Review acquisition channels and campaign pacing for this asset.'
              when category like '%benchmark%'
                then 'Compare competitor tactics for this KPI and isolate the largest monthly delta driver.'
              else 'Review segment-level drivers and data quality checks before taking action.' end
           as suggested_next_investigation
  from BR)
"""


def gold_sql(fallback: bool = False, board: bool = False) -> str:
    """Oracle CTEs: H (health), B (benchmark), SG (signals), PA/PE (priority inputs), BR/BD (board)."""
    pri = PRIORITY_CTE.format(weight=WEIGHT_FALLBACK if fallback else WEIGHT_DICT,
                              join=JOIN_FALLBACK if fallback else JOIN_DICT)
    out = HEALTH_ROWS + BENCH_CTE.format(s="S", p="P", k=5) + SIGNALS_CTE + pri
    return out + (BOARD_CTE.replace("{{", "{").replace("}}", "}") if board else "")
