"""Peer benchmark checks: stats, rank and gaps, full benchmark, optional extra source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import PeerConfig
from kpiloom.operators.peers import KEYS, peer_benchmark, peer_rank_gap, peer_stats
from kpiloom.plans.fixtures import EXTRA_MEASURES, SUBJECT_REGION, Inputs
from kpiloom.plans.registry import register

# Independent SQL: peer stats per key, rank() over peers + subject, gaps, 12-row lags.
# {s} and {p} name the subject / peer relations, {k} is the minimum number of distinct clubs.
BENCH_CTE = """
, ps as (
  select month, asset_name, metric_name, quantile_disc(peer_value, 0.5) as peer_median,
         (sum((peer_value * 1048576.0 - fmod(peer_value * 1048576.0, 1.0)) / 1048576.0)
          + sum(fmod(peer_value * 1048576.0, 1.0) / 1048576.0)) / count(peer_value) as peer_mean,
         max(peer_value) as mx, min(peer_value) as mn,
         count(distinct club) as club_count
  from {p} group by 1, 2, 3 having count(distinct club) >= {k}),
al as (
  select s.month, s.asset_name, s.metric_name, s.metric_value as subject_value, ps.peer_median, ps.peer_mean,
         ps.mx, ps.mn, ps.club_count, coalesce(d.polarity, 1) as pol
  from {s} s join ps on s.month = ps.month and s.asset_name = ps.asset_name and s.metric_name = ps.metric_name
  left join D d on s.metric_name = d.metric_name),
rb as (
  select p.month, p.asset_name, p.metric_name, p.peer_value * al.pol as adj, 0 as is_s
  from {p} p join al on p.month = al.month and p.asset_name = al.asset_name and p.metric_name = al.metric_name
  union all
  select month, asset_name, metric_name, subject_value * pol, 1 from al),
rk as (
  select month, asset_name, metric_name,
         rank() over (partition by month, asset_name, metric_name order by adj desc) as r, is_s from rb),
g as (
  select al.*, cast(rk.r as integer) as subject_rank,
         case when pol = -1 then mn else mx end as peer_leader_value,
         pol * (subject_value - peer_median) as gap_to_peer_median,
         pol * (subject_value - case when pol = -1 then mn else mx end) as gap_to_leader
  from al join rk on al.month = rk.month and al.asset_name = rk.asset_name and al.metric_name = rk.metric_name
  where rk.is_s = 1),
B as (
  select *, cast(lag(subject_rank, 12) over w - subject_rank as integer) as rank_change_12m,
         gap_to_peer_median - lag(gap_to_peer_median, 12) over w as gap_change_12m
  from g window w as (partition by asset_name, metric_name order by month))
"""
BENCH_SELECT = """
select month, asset_name, metric_name, subject_value, peer_median, peer_mean,
       peer_leader_value, subject_rank, club_count, gap_to_peer_median, gap_to_leader, rank_change_12m,
       gap_change_12m
from B
"""
EXTRA_CTE = """
, WR as (
  select cast(date_trunc('month', o_orderdate) as date) as month, r_name as club_name,
         cast(count(*) as double) as order_count,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as net_sales,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as cart_value
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey group by 1, 2),
FR as (
  select month, club_name, 'extra' as asset_name, metric_name, metric_value
  from (unpivot WR on order_count, net_sales, cart_value into name metric_name value metric_value)),
S2 as (select * from S union all
       select month, asset_name, metric_name, metric_value from FR where club_name = 'AFRICA'),
P2 as (select * from P union all
       select month, asset_name, metric_name, metric_value, club_name from FR where club_name <> 'AFRICA')
"""


@register("peer_stats", BENCH_CTE.format(s="S", p="P", k=5) + """
select month, asset_name, metric_name, peer_median, peer_mean, mx as peer_max_value,
       mn as peer_min_value, club_count from al
""")
def q_peer_stats(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf, shared=True)
    st = peer_stats(inp.subject_fact(), inp.peer_fact(), inp.metric_dim())
    return st.select(*KEYS, "peer_median", "peer_mean", "peer_max_value", "peer_min_value", "club_count")


@register("peer_rank_gap", BENCH_CTE.format(s="S", p="P", k=5) + """
select month, asset_name, metric_name, subject_value, peer_leader_value, subject_rank, gap_to_peer_median,
       gap_to_leader from g
""")
def q_peer_rank_gap(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf, shared=True)
    g = peer_rank_gap(peer_stats(inp.subject_fact(), inp.peer_fact(), inp.metric_dim()))
    return g.select(*KEYS, "subject_value", "peer_leader_value", "subject_rank", "gap_to_peer_median",
                    "gap_to_leader")


@register("peer_rank_gap_repeated_subject", """
, SR as (select month, asset_name, metric_name, max(metric_value) as metric_value
         from (select * from S union all select month, asset_name, metric_name, metric_value * 1.5 from S) t group by 1, 2, 3)
""" + BENCH_CTE.format(s="SR", p="P", k=5) + """
select month, asset_name, metric_name, subject_value, peer_leader_value, subject_rank, gap_to_peer_median,
       gap_to_leader from g
""")
def q_peer_rank_gap_repeated_subject(spark: SparkSession, sf: str) -> DataFrame:
    """A subject key that occurs twice is ranked once, by its largest value."""
    inp = Inputs(spark, sf, shared=True)
    subject = inp.subject_fact()
    twice = subject.unionByName(subject.withColumn("metric_value", F.col("metric_value") * 1.5))
    g = peer_rank_gap(peer_stats(twice, inp.peer_fact(), inp.metric_dim()))
    return g.select(*KEYS, "subject_value", "peer_leader_value", "subject_rank", "gap_to_peer_median", "gap_to_leader")


@register("peer_benchmark", BENCH_CTE.format(s="S", p="P", k=5) + BENCH_SELECT)
def q_peer_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf, shared=True)
    return peer_benchmark(inp.subject_fact(), inp.peer_fact(), inp.metric_dim())


@register("peer_benchmark_extra_source", EXTRA_CTE + BENCH_CTE.format(s="S2", p="P2", k=4) + BENCH_SELECT)
def q_peer_benchmark_extra_source(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf, shared=True)
    bench = peer_benchmark(inp.subject_fact(), inp.peer_fact(), inp.metric_dim(), extra=inp.wide_regions(),
                           extra_subject=SUBJECT_REGION, extra_asset="extra", extra_measures=EXTRA_MEASURES,
                           cfg=PeerConfig(min_clubs=4))
    return bench
