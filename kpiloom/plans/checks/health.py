"""KPI health checks: lags/trend, rolling deviation, seasonal z, full health, calendar mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import HealthConfig
from kpiloom.functions import guarded_relative_deviation, safe_z, trend
from kpiloom.operators.health import kpi_health, lags_and_rolling, seasonal_stats
from kpiloom.plans.fixtures import Inputs
from kpiloom.plans.registry import register
from kpiloom.sources.config_json import default_metric_dim

# Health of the subject series as independent SQL; {order} and {frames} switch row/calendar mode.
HEALTH_CTE = """
, sk as (
  select s.*, first(s.metric_value) over (partition by s.asset_name, s.metric_name, month(s.month)
                                          order by s.month) as k,
         (s.metric_value * 1048576.0 - fmod(s.metric_value * 1048576.0, 1.0)) / 1048576.0 as hi,
         fmod(s.metric_value * 1048576.0, 1.0) / 1048576.0 as lo
  from S s),
hb as (
  select s.month, s.asset_name, s.metric_name, s.metric_value, coalesce(d.polarity, 1) as pol,
         {prior} as prior_month_value,
         {season} as prior_season_same_month_value,
         (sum(s.hi) over (w {rolling}) + sum(s.lo) over (w {rolling})) / count(s.metric_value) over (w {rolling})
           as rolling_12m_avg,
         (sum(s.hi) over ws + sum(s.lo) over ws) / count(s.metric_value) over ws as s_mean,
         sum(s.metric_value - s.k) over ws as s_s1,
         sum((s.metric_value - s.k) * (s.metric_value - s.k)) over ws as s_s2,
         count(s.metric_value) over ws as s_cnt
  from sk s left join D d on s.metric_name = d.metric_name
  window w as (partition by s.asset_name, s.metric_name order by {order}),
         ws as (partition by s.asset_name, s.metric_name, month(s.month) order by s.month
                rows between unbounded preceding and 1 preceding)),
hv as (
  select *, case when s_cnt >= 2
                 then sqrt(greatest(0.0::double, (s_s2 - s_s1 * s_s1 / s_cnt) / (s_cnt - 1))) end as s_std
  from hb),
hd as (
  select *, case when rolling_12m_avg <> 0 then (metric_value - rolling_12m_avg) / rolling_12m_avg end as dev
  from hv),
H as (
  select month, asset_name, metric_name, metric_value, prior_month_value, prior_season_same_month_value,
         rolling_12m_avg, dev as deviation_from_rolling_avg, s_mean, s_std, s_cnt,
         case when s_cnt >= 2 and s_std > 0 then (metric_value - s_mean) / s_std else 0.0 end as seasonal_z_score,
         case when metric_value > prior_month_value then 'up'
              when metric_value < prior_month_value then 'down' else 'flat' end as trend_direction,
         case when pol = 1 and dev > 0.05 then 'good' when pol = 1 and dev < -0.05 then 'review'
              when pol = -1 and dev < -0.05 then 'good' when pol = -1 and dev > 0.05 then 'review'
              else 'stable' end as health_status
  from hd)
"""
ROW_MODE = dict(order="s.month", prior="lag(s.metric_value, 1) over w",
                season="lag(s.metric_value, 12) over w",
                rolling="rows between 11 preceding and current row")
CAL_MODE = dict(order="year(s.month) * 12 + month(s.month)",
                prior="first(s.metric_value) over (w range between 1 preceding and 1 preceding)",
                season="first(s.metric_value) over (w range between 12 preceding and 12 preceding)",
                rolling="range between 11 preceding and current row")
HEALTH_ROWS = HEALTH_CTE.format(**ROW_MODE)
HEALTH_CAL = HEALTH_CTE.format(**CAL_MODE)
HEALTH_SELECT = """
select month, asset_name, metric_name, metric_value, prior_month_value, prior_season_same_month_value,
       rolling_12m_avg, deviation_from_rolling_avg, seasonal_z_score,
       trend_direction, health_status
from H
"""


@register("kpi_lags_trend", HEALTH_ROWS + """
select month, asset_name, metric_name, metric_value, prior_month_value, prior_season_same_month_value,
       trend_direction from H
""")
def q_kpi_lags_trend(spark: SparkSession, sf: str) -> DataFrame:
    df = lags_and_rolling(Inputs(spark, sf).subject_fact())
    return df.select("month", "asset_name", "metric_name", "metric_value", "prior_month_value",
                     "prior_season_same_month_value",
                     trend(F.col("metric_value"), F.col("prior_month_value")).alias("trend_direction"))


@register("kpi_rolling_deviation", HEALTH_ROWS + """
select month, asset_name, metric_name, rolling_12m_avg, deviation_from_rolling_avg from H
""")
def q_kpi_rolling_deviation(spark: SparkSession, sf: str) -> DataFrame:
    df = lags_and_rolling(Inputs(spark, sf).subject_fact())
    return df.select("month", "asset_name", "metric_name", "rolling_12m_avg",
                     guarded_relative_deviation(F.col("metric_value"), F.col("rolling_12m_avg"))
                     .alias("deviation_from_rolling_avg"))


@register("kpi_seasonal_z", HEALTH_ROWS + """
select month, asset_name, metric_name, s_mean as seasonal_mean, s_std as seasonal_std,
       s_cnt as seasonal_count, seasonal_z_score from H
""")
def q_kpi_seasonal_z(spark: SparkSession, sf: str) -> DataFrame:
    cfg = HealthConfig()
    df = seasonal_stats(Inputs(spark, sf).subject_fact())
    out = df.select("month", "asset_name", "metric_name", "seasonal_mean", "seasonal_std", "seasonal_count",
                    safe_z(F.col("metric_value"), F.col("seasonal_mean"), F.col("seasonal_std"),
                           F.col("seasonal_count"), cfg.min_season_history).alias("seasonal_z_score"))
    return out


@register("kpi_health", HEALTH_ROWS + HEALTH_SELECT)
def q_kpi_health(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf)
    return kpi_health(inp.subject_fact(), inp.metric_dim())


@register("kpi_health_calendar", HEALTH_CAL + HEALTH_SELECT)
def q_kpi_health_calendar(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf)
    return kpi_health(inp.subject_fact(), inp.metric_dim(), HealthConfig(calendar=True))


@register("health_default_dictionary", HEALTH_ROWS.replace("from S s)", "from SD s)", 1).replace("left join D d", "left join DD d").replace(", sk as (", """
, SD as (select month, asset_name, case metric_name when 'return_rate' then 'bounce_rate' when 'units' then 'visits' else metric_name end as metric_name,
                metric_value from S),
DD as (select * from (values ('net_sales', 1), ('cart_value', 1), ('bounce_rate', -1), ('visits', 1)) t(metric_name, polarity)),
sk as (""", 1) + HEALTH_SELECT)
def q_health_default_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Health with the shipped dictionary; two measures take the names of known metrics (one of them better when low)."""
    fact = Inputs(spark, sf).subject_fact()
    known = F.when(F.col("metric_name") == "return_rate", "bounce_rate").when(F.col("metric_name") == "units", "visits")
    return kpi_health(fact.withColumn("metric_name", F.coalesce(known, "metric_name")), default_metric_dim(spark))
