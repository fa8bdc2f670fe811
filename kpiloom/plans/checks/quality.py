"""Data-quality checks on clean and on seeded-bad inputs; gate + run log round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.quality import RESULT_COLUMNS, QualityConfig, QualityGateError, quality_checks, quality_gate
from kpiloom.plans.fixtures import Inputs
from kpiloom.plans.registry import register
from kpiloom.session import scratch_path

DQ_CFG = QualityConfig(expected_clubs=24)


def facts(inp: Inputs) -> tuple[DataFrame, DataFrame]:
    inp.shared = True
    internal = inp.subject_fact()
    bench = inp.peer_fact().withColumnRenamed("peer_value", "metric_value")
    return internal, bench


def seeded_bad(internal: DataFrame, bench: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bad copies derived from the data: duplicated out-of-range rates, NULL months, NULL values,
    duplicated peer rows."""
    m = F.col("metric_name")
    bad_i = internal.unionByName(
        internal.filter(m == "return_rate").withColumn("metric_value", F.col("metric_value") + 1.5)
    ).unionByName(
        internal.filter(m == "units").withColumn("month", F.lit(None).cast("date"))
    ).unionByName(
        internal.filter(m == "order_count").withColumn("metric_value", F.lit(None).cast("double")))
    bad_b = bench.unionByName(bench.filter(F.col("club") == "NATION_1"))
    return bad_i, bad_b


# Oracle: the same checks written directly over the two facts (clean and seeded-bad copies).
DQ_CTE = """
, I0 as (select month, asset_name, metric_name, metric_value from S),
B0 as (select month, asset_name, metric_name, peer_value as metric_value, club from P),
I1 as (select * from I0
       union all select month, asset_name, metric_name, metric_value + 1.5 from I0 where metric_name = 'return_rate'
       union all select null, asset_name, metric_name, metric_value from I0 where metric_name = 'units'
       union all select month, asset_name, metric_name, null from I0 where metric_name = 'order_count'),
B1 as (select * from B0 union all select * from B0 where club = 'NATION_1')
"""
DQ_RUN = """
select '{run}' as run_id, 'internal_fact' as table_name, 'No null months' as check_name,
       count(*) filter (where month is null) as issue_count, 'Failed condition: month IS NOT NULL' as issue_details
from {i}
union all
select '{run}', 'internal_fact', 'No null metric values', count(*) filter (where metric_value is null),
       'Failed condition: metric_value IS NOT NULL' from {i}
union all
select '{run}', 'internal_fact', 'No duplicate keys on (month, asset_name, metric_name)', count(*),
       'Duplicate key groups found for columns: [''month'', ''asset_name'', ''metric_name'']'
from (select 1 from {i} group by month, asset_name, metric_name having count(*) > 1) t
union all
select '{run}', 'internal_fact', 'Complete monthly coverage by asset+metric',
       (select count(*) from (select asset_name, metric_name, count(distinct month) as mc from {i} group by 1, 2) x
        where mc <> (select count(distinct month) + max(case when month is null then 1 else 0 end) from {i})),
       'Expected each asset+metric to have month_count == '
       || cast((select count(distinct month) + max(case when month is null then 1 else 0 end) from {i}) as varchar) || '.'
union all
select '{run}', 'internal_fact', 'Rate metrics bounded between 0 and 1',
       count(*) filter (where regexp_matches(metric_name, '(_rate$|bounce_rate$)')
                        and (metric_value < 0 or metric_value > 1 or isnan(metric_value))),
       'Found rate metric_value outside [0,1]. Note: recurrence metrics are excluded as they are counts, not rates.'
from {i}
union all
select '{run}', 'benchmark_fact', 'No duplicate keys on (month, asset_name, metric_name, club)', count(*),
       'Duplicate key groups found for columns: [''month'', ''asset_name'', ''metric_name'', ''club'']'
from (select 1 from {b} group by month, asset_name, metric_name, club having count(*) > 1) t
union all
select '{run}', 'benchmark_fact', 'Exactly 24 benchmark clubs per month+asset+metric', count(*),
       'Expected club_count == 24 for each month, asset_name, metric_name.'
from (select 1 from {b} group by month, asset_name, metric_name having count(distinct club) <> 24) t
"""


def dq_sql(run: str, i: str, b: str) -> str:
    body = DQ_RUN.format(run=run, i=i, b=b)
    return f"""
select run_id, table_name, check_name, 'REQUIRED' as severity,
       case when issue_count = 0 then 'PASS' else 'FAIL' end as status, cast(issue_count as bigint) as issue_count,
       issue_details from ({body}) r"""


@register("dq_results", DQ_CTE + dq_sql("clean", "I0", "B0") + "\nunion all\n" + dq_sql("seeded", "I1", "B1"))
def q_dq_results(spark: SparkSession, sf: str) -> DataFrame:
    internal, bench = facts(Inputs(spark, sf))
    bad_i, bad_b = seeded_bad(internal, bench)
    clean = quality_checks(internal, bench, "clean", "internal_fact", "benchmark_fact", DQ_CFG)
    seeded = quality_checks(bad_i, bad_b, "seeded", "internal_fact", "benchmark_fact", DQ_CFG)
    return clean.unionByName(seeded)


DATES_CTE = DQ_CTE + """
, I2 as (select * from I0 union all
         select cast(month + 30 as date), asset_name, metric_name, metric_value from I0 where day(month) = 1)
"""


@register("dq_results_any_date", DATES_CTE + dq_sql("dates", "I2", "B0").replace(
    "'REQUIRED' as severity", "case when check_name like 'Complete%' then 'ADVISORY' else 'REQUIRED' end as severity"))
def q_dq_results_any_date(spark: SparkSession, sf: str) -> DataFrame:
    """Several dates in one calendar month are months of their own; one check does not block."""
    internal, bench = facts(Inputs(spark, sf))
    more = internal.unionByName(internal.filter(F.dayofmonth("month") == 1).withColumn("month", F.date_add("month", 30)))
    cfg = QualityConfig(expected_clubs=24, severities=(("Complete monthly coverage by asset+metric", "ADVISORY"),))
    return quality_checks(more, bench, "dates", "internal_fact", "benchmark_fact", cfg)


@register("dq_gate_log", DQ_CTE + "select *, true as gate_raised from (" + dq_sql("seeded", "I1", "B1") + ") g")
def q_dq_gate_log(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded-bad run, tried twice: the gate raises, the log holds the run once and is read back."""
    internal, bench = facts(Inputs(spark, sf))
    bad_i, bad_b = seeded_bad(internal, bench)
    results = quality_checks(bad_i, bad_b, "seeded", "internal_fact", "benchmark_fact", DQ_CFG)
    log = scratch_path(spark, "dq_log")
    raised = True
    for _ in range(2):                  # retried: logged once
        try:
            quality_gate(results, log)
            raised = False
        except QualityGateError:
            pass
    return spark.read.parquet(log).select(*RESULT_COLUMNS).withColumn("gate_raised", F.lit(raised))
