"""Signal checks: pivot, lagged correlations, validated top signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import SignalConfig
from kpiloom.operators.signals import discover_signals, lag_correlations, metric_pivot
from kpiloom.plans.fixtures import W_MEASURES, Inputs
from kpiloom.plans.registry import register, rounded

# Signal parameters used with the derived data (no pair reaches 0.65 there, so 0.25 is used).
FIXTURE_CANDIDATES = (
    ("furniture", "net_sales", "Furniture sales lead {} in the following months."),
    ("household", "return_rate", "Household returns move ahead of {}."),
    ("building", "cart_value", "Building basket size anticipates {}."),
)
FIXTURE_TARGETS = (("building", "order_count"), ("furniture", "return_rate"), ("furniture", "net_sales"))
FIXTURE_SIGNALS = SignalConfig(min_abs_corr=0.25)
WIDE_CANDIDATES = tuple((a, m, "{}") for a in ("furniture", "household") for m in W_MEASURES)
WIDE_TARGETS = tuple(("building", m) for m in W_MEASURES)
PIVOT_FEATURES = tuple((a, m) for a in ("automobile", "machinery") for m in ("net_sales", "return_rate"))


def fixture_signals(inp: Inputs) -> DataFrame:
    inp.shared = True          # the month list and the series are two branches over the fact
    return discover_signals(inp.subject_fact(), FIXTURE_CANDIDATES, FIXTURE_TARGETS, FIXTURE_SIGNALS)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(x) if not isinstance(x, str) else "'" + x.replace("'", "''") + "'"
                                     for x in r) + ")" for r in rows)


def pairs_sql(candidates, targets, lags=(1, 2, 3)) -> str:
    rows = [(ci, ca, cm, t, ti, ta, tm, lag) for ci, (ca, cm, t) in enumerate(candidates)
            for ti, (ta, tm) in enumerate(targets) for lag in lags]
    return (f"pr as (select * from (values {_values(rows)}) t(source_ord, source_asset, source_metric, template, "
            "target_ord, target_asset, target_metric, lag_months))")


# Oracle: number the distinct months, pair source(p) with target(p + lag), guarded correlation.
CORR_CTE = """
, mp as (select month, row_number() over (order by month) as pos from (select distinct month from S)),
ser as (select s.asset_name, s.metric_name, mp.pos, max(s.metric_value) as v
        from S s join mp on s.month = mp.month group by 1, 2, 3),
{pairs},
cr as (
  select pr.source_ord, pr.target_ord, pr.source_asset, pr.source_metric, pr.target_asset, pr.target_metric,
         pr.lag_months, pr.template, count(*) as n_pairs,
         case when stddev_pop(x.v) * stddev_pop(y.v) = 0 then null
              else covar_pop(x.v, y.v) / (stddev_pop(x.v) * stddev_pop(y.v)) end as strength_score
  from pr join ser x on x.asset_name = pr.source_asset and x.metric_name = pr.source_metric
          join ser y on y.asset_name = pr.target_asset and y.metric_name = pr.target_metric
                    and y.pos = x.pos + pr.lag_months
  where x.v is not null and y.v is not null and not isnan(x.v) and not isnan(y.v)
  group by 1, 2, 3, 4, 5, 6, 7, 8)
"""
SIGNALS_CTE = CORR_CTE.format(pairs=pairs_sql(FIXTURE_CANDIDATES, FIXTURE_TARGETS)) + """
, SG as (
  select source_asset, source_metric, target_asset, target_metric, cast(lag_months as integer) as lag_months,
         case when strength_score > 0 then 'positive' else 'negative' end as relationship_direction,
         strength_score, 'active' as validation_status,
         replace(template, '{}', target_asset || ' ' || target_metric) as business_interpretation,
         (select max(month) from S) as last_validated_month
  from cr where n_pairs > 12 and strength_score is not null and abs(strength_score) > 0.25
  order by abs(strength_score) desc, source_ord, target_ord, lag_months limit 3)
"""


@register("metric_pivot", """
select month,
  max(case when asset_name = 'automobile' and metric_name = 'net_sales' then metric_value end) as automobile_net_sales,
  max(case when asset_name = 'automobile' and metric_name = 'return_rate' then metric_value end) as automobile_return_rate,
  max(case when asset_name = 'machinery' and metric_name = 'net_sales' then metric_value end) as machinery_net_sales,
  max(case when asset_name = 'machinery' and metric_name = 'return_rate' then metric_value end) as machinery_return_rate
from S group by month
""")
def q_metric_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return metric_pivot(Inputs(spark, sf).subject_fact(), PIVOT_FEATURES)


@register("lag_correlations", CORR_CTE.format(pairs=pairs_sql(WIDE_CANDIDATES, WIDE_TARGETS)) + """
select source_asset, source_metric, target_asset, target_metric, lag_months, n_pairs,
       round(strength_score, 9) as strength_score from cr
""")
def q_lag_correlations(spark: SparkSession, sf: str) -> DataFrame:
    corr = lag_correlations(Inputs(spark, sf, shared=True).subject_fact(), WIDE_CANDIDATES, WIDE_TARGETS)
    out = corr.select("source_asset", "source_metric", "target_asset", "target_metric", "lag_months",
                      "n_pairs", "strength_score")
    return rounded(out, "strength_score")


@register("lag_correlations_missing_values", CORR_CTE.format(pairs=pairs_sql(WIDE_CANDIDATES, WIDE_TARGETS)).replace("from S", "from SM")
          .replace(", mp as (", """
, SM as (select month, asset_name, metric_name,
                case when asset_name = 'building' and month(month) % 3 = 0 then null
                     when asset_name = 'furniture' and month(month) % 4 = 0 then 'nan'::double else metric_value end as metric_value
         from S), mp as (""", 1) + """
select source_asset, source_metric, target_asset, target_metric, lag_months, n_pairs,
       round(strength_score, 9) as strength_score from cr
""")
def q_lag_correlations_missing_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every third target month without a value, every fourth source month NaN: such pairs do not count."""
    month, v = F.month("month"), F.col("metric_value")
    gaps = (F.when((F.col("asset_name") == "building") & (month % 3 == 0), F.lit(None).cast("double"))
            .when((F.col("asset_name") == "furniture") & (month % 4 == 0), F.lit(float("nan"))).otherwise(v))
    fact = Inputs(spark, sf, shared=True).subject_fact().withColumn("metric_value", gaps)
    out = lag_correlations(fact, WIDE_CANDIDATES, WIDE_TARGETS).select(
        "source_asset", "source_metric", "target_asset", "target_metric", "lag_months", "n_pairs", "strength_score")
    return rounded(out, "strength_score")


@register("signals_top", SIGNALS_CTE + """
select source_asset, source_metric, target_asset, target_metric, lag_months, relationship_direction,
       round(strength_score, 9) as strength_score, validation_status, business_interpretation,
       last_validated_month from SG
""")
def q_signals_top(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixture_signals(Inputs(spark, sf)), "strength_score")
