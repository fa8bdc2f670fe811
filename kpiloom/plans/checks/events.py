"""Event-window check on the daily event series with large purchases as annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators.events import event_windows
from kpiloom.plans.fixtures import Inputs
from kpiloom.plans.registry import register


@register("event_windows", """
, aw as (select A.event_id, A.asset_name, A.event_day, o.off as period_offset,
                A.event_day + cast(o.off as integer) as day
         from A join range(-3, 4) o(off) on true),
ej as (select aw.event_id, aw.asset_name, E.metric_name, aw.event_day as event_period, aw.period_offset,
              E.metric_value
       from aw join E on E.asset_name = aw.asset_name and E.day = aw.day),
eb0 as (select *, case when period_offset < 0 then metric_value * 1048576.0 end as a from ej),
eb as (select *, (sum((a - fmod(a, 1.0)) / 1048576.0) over w + sum(fmod(a, 1.0) / 1048576.0) over w)
                 / count(a) over w as baseline
       from eb0 window w as (partition by event_id, asset_name, metric_name))
select event_id, asset_name, metric_name, event_period, cast(period_offset as integer) as period_offset,
       metric_value, baseline, case when baseline <> 0 then (metric_value - baseline) / baseline end as deviation
from eb
""")
def q_event_windows(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf)
    return event_windows(inp.daily_series(), inp.annotations(), before=3, after=3)
