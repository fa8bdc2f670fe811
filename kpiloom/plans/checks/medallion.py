"""End-to-end checks: what the persisted DAG leaves in its tables, against the same SQL as the single operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.plans.checks.gold import FIXTURE_PRIORITY
from kpiloom.plans.checks.peers import BENCH_CTE, BENCH_SELECT, EXTRA_CTE
from kpiloom.plans.checks.signals import FIXTURE_CANDIDATES, FIXTURE_SIGNALS, FIXTURE_TARGETS
from kpiloom.plans.checks.silver import SILVER_CTE, KEPT, INTERNAL_NAMES, benchmark_sheets, internal_sheets, shared_wide
from kpiloom.plans.fixtures import EXTRA_MEASURES, SUBJECT, SUBJECT_REGION, W_MEASURES, Inputs
from kpiloom.plans.medallion import Medallion, MedallionConfig
from kpiloom.plans.registry import register
from kpiloom.config import PeerConfig
from kpiloom.session import scratch_path


def config(**kw) -> MedallionConfig:
    """The derived sheet has gaps by design, so the gate only logs."""
    return MedallionConfig(candidates=FIXTURE_CANDIDATES, targets=FIXTURE_TARGETS, signals=FIXTURE_SIGNALS, priority=FIXTURE_PRIORITY,
                           fail_on_quality=False, **kw)


def with_extra(spark: SparkSession, sf: str, present: bool) -> DataFrame:
    inp = Inputs(spark, sf)
    path = scratch_path(spark, "extra_source")
    if present:
        inp.wide_regions().write.parquet(path)
    cfg = config(measures=W_MEASURES, extra_source=path, extra_subject=SUBJECT_REGION, extra_asset="extra", extra_measures=EXTRA_MEASURES,
                 peers=PeerConfig(min_clubs=4))
    return Medallion(spark).run(inp.wide(), inp.metric_dim(), cfg)["bench"]


@register("medallion_extra_source", EXTRA_CTE + BENCH_CTE.format(s="S2", p="P2", k=4) + BENCH_SELECT)
def q_medallion_extra_source(spark: SparkSession, sf: str) -> DataFrame:
    """The DAG's benchmark when the optional source is there."""
    return with_extra(spark, sf, True)


@register("medallion_without_extra_source", BENCH_CTE.format(s="S", p="P", k=4) + BENCH_SELECT)
def q_medallion_without_extra_source(spark: SparkSession, sf: str) -> DataFrame:
    """The DAG's benchmark when the named optional source does not exist."""
    return with_extra(spark, sf, False)


@register("medallion_sheets", SILVER_CTE + f"""
, facts as (
  select month, asset_name, metric_name, value from told join {INTERNAL_NAMES} using (metric) where club = '{SUBJECT}' and {KEPT}),
rejected as (
  select asset_name, 'month' as what, month from told where bad_month group by asset_name, month, club
  union all select t.asset_name, n.metric_name, month from told t join {INTERNAL_NAMES} using (metric) where club = '{SUBJECT}' and bad_value
  union all select t.asset_name, 'visits', month from told t where metric = 'order_count' and club <> '{SUBJECT}' and bad_value)
select asset_name, metric_name, 'fact' as kind, count(*) as n, min(month) as first_month, max(month) as last_month from facts group by 1, 2
union all
select asset_name, what, 'reject', count(*), null, null from rejected group by 1, 2
""")
def q_medallion_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """The DAG from one raw sheet per asset: what its silver fact holds, and what was rejected."""
    inp = shared_wide(Inputs(spark, sf))
    out = Medallion(spark).run_sheets(internal_sheets(inp), benchmark_sheets(inp), None, config())
    facts = out["internal"].groupBy("asset_name", "metric_name").agg(
        F.lit("fact").alias("kind"), F.count("*").alias("n"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    rejects = out["rejects"].groupBy("asset_name", F.col("column_name").alias("metric_name")).agg(
        F.lit("reject").alias("kind"), F.count("*").alias("n"), F.lit(None).cast("date").alias("first_month"), F.lit(None).cast("date").alias("last_month"))
    return facts.unionByName(rejects)
