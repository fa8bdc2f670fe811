import pytest

from conftest import SMOKE
from kpiloom.operators.quality import QualityGateError
from kpiloom.plans.checks.gold import FIXTURE_PRIORITY
from kpiloom.plans.checks.signals import FIXTURE_CANDIDATES, FIXTURE_TARGETS
from kpiloom.plans.fixtures import W_MEASURES, Inputs
from kpiloom.plans.medallion import Medallion, MedallionConfig
from kpiloom.session import scratch_path


def config(**kw):
    kw.setdefault("fail_on_quality", False)         # the smoke data has incomplete series
    return MedallionConfig(measures=W_MEASURES, candidates=FIXTURE_CANDIDATES, targets=FIXTURE_TARGETS,
                           priority=FIXTURE_PRIORITY, **kw)


def test_end_to_end_persists_every_stage(spark):
    inp = Inputs(spark, SMOKE)
    m = Medallion(spark, scratch_path(spark, "medallion_test"))
    out = m.run(inp.wide(), inp.metric_dim(), config())
    rows = {r.name: r.rows for r in m.results}
    assert rows["silver_internal"] + rows["silver_benchmark"] == inp.fact().count()
    assert rows["gold_kpi_health"] == 231 == out["health"].count()
    assert rows["gold_priority_board"] <= 10 * out["health"].select("month").distinct().count()
    assert rows["gold_monthly_brief_inputs"] == out["health"].select("month").distinct().count()
    assert rows["gold_signal_relationships"] == 0               # no pair has 13 aligned months at sf0.001
    # raw data has incomplete series: the gate fails, is logged, and does not block gold
    assert m.quality_error and "Complete monthly coverage" in m.quality_error
    log = spark.read.parquet(f"{m.root}/quality_log")
    assert log.count() == 7 and "run_timestamp" in log.columns


def test_blocking_quality_gate(spark):
    inp = Inputs(spark, SMOKE)
    with pytest.raises(QualityGateError):
        Medallion(spark, scratch_path(spark, "medallion_block")).run(inp.wide(), inp.metric_dim(),
                                                                     config(fail_on_quality=True))


def test_month_partitioned_facts_prune(spark):
    inp = Inputs(spark, SMOKE)
    m = Medallion(spark, scratch_path(spark, "medallion_parts"))
    out = m.run(inp.wide(), inp.metric_dim(), config(partition_by_month=True))
    one = out["health"].filter("month = date'1996-01-01'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert one.count() == out["health"].filter("month = date'1996-01-01'").count()
