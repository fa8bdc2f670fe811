"""KPI health (HLT: WIN1-6, CLS1-3, PRJ10-12).

Per series (asset, metric) ordered by month: prior value, value 12 rows back, rolling 12-row mean,
relative deviation from it, a seasonal z-score against earlier rows of the same calendar month,
a trend label and a polarity-aware health status.

Plan: one hash exchange on (asset_name, metric_name). The seasonal window adds the calendar month
to the key; the existing clustering already satisfies it, so it only re-sorts. A series holds one
row per month (enforced by the duplicate check), so a window partition is bounded by the number of
months, whatever the total data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.config import STATUS_GOOD, STATUS_REVIEW, STATUS_STABLE, HealthConfig
from kpiloom.functions import first_match, guarded_relative_deviation, safe_z, signed_by_polarity, split_mean, trend
from kpiloom.functions.expressions import sized_broadcast
from kpiloom.sources.config_json import default_metric_dim

SERIES = ("asset_name", "metric_name")
HEALTH_COLUMNS = (
    "month", "asset_name", "metric_name", "metric_value",
    "prior_month_value", "prior_season_same_month_value", "rolling_12m_avg",
    "deviation_from_rolling_avg", "seasonal_z_score",
    "trend_direction", "health_status",
)


def with_polarity(df: DataFrame, metric_dim: DataFrame | None, default: int = 1) -> DataFrame:
    """Attach ``polarity`` from the metric dimension (broadcast when its estimated size is small).

    Without a dimension the shipped dictionary holds; metrics that it does not know get ``default``.
    """
    if metric_dim is None:
        metric_dim = default_metric_dim(df.sparkSession)
    dim = metric_dim.select("metric_name", F.col("polarity").cast("int").alias("polarity"))
    return (df.join(sized_broadcast(dim), "metric_name", "left")
              .withColumn("polarity", F.coalesce("polarity", F.lit(default))))


def month_index(month: str = "month"):
    """Calendar month number (year*12 + month) for calendar-exact frames."""
    return F.year(month) * 12 + F.month(month)


def lags_and_rolling(df: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """prior_month_value, prior_season_same_month_value, rolling_12m_avg (WIN1-3)."""
    v = F.col("metric_value")
    if cfg.calendar:
        w = Window.partitionBy(*SERIES).orderBy(month_index())
        cols = {
            "prior_month_value": F.first(v).over(w.rangeBetween(-1, -1)),
            "prior_season_same_month_value": F.first(v).over(w.rangeBetween(-cfg.season_lag, -cfg.season_lag)),
            "rolling_12m_avg": split_mean(v, w.rangeBetween(-(cfg.rolling_rows - 1), 0)),
        }
    else:
        w = Window.partitionBy(*SERIES).orderBy("month")
        cols = {
            "prior_month_value": F.lag(v, 1).over(w),
            "prior_season_same_month_value": F.lag(v, cfg.season_lag).over(w),
            "rolling_12m_avg": split_mean(v, w.rowsBetween(-(cfg.rolling_rows - 1), 0)),
        }
    return df.withColumns(cols)


def seasonal_stats(df: DataFrame) -> DataFrame:
    """Mean, sample std and count of earlier rows with the same calendar month (WIN4-6).

    The sample variance comes from frame sums of values shifted by the first value of the
    same-month series (``(S2 - S1^2/n) / (n - 1)`` on ``x - K``). Values of one series and calendar
    month are close to K, so this is as well conditioned as Welford's update, and because every
    term is a plain in-order frame sum the result is reproducible bit for bit, on any engine.
    """
    # The calendar month is a column, so every seasonal window shares one partitioning attribute.
    part = Window.partitionBy(*SERIES, "_cal").orderBy("month")
    prior = part.rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("metric_value")
    shifted = df.withColumn("_cal", F.month("month")).withColumn(
        "_k", F.first(v).over(part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    d = v - F.col("_k")
    n = F.count(v).over(prior)
    s1, s2 = F.sum(d).over(prior), F.sum(d * d).over(prior)
    var = F.greatest(F.lit(0.0), (s2 - s1 * s1 / n) / (n - 1))
    return shifted.withColumns({
        "seasonal_mean": split_mean(v, prior),
        "seasonal_std": F.when(n >= 2, F.sqrt(var)),
        "seasonal_count": n,
    }).drop("_k", "_cal")


def health_status(deviation, polarity, threshold: float):
    """good / review / stable from the polarity-oriented deviation (CLS3)."""
    oriented = signed_by_polarity(deviation, polarity)
    return first_match([(oriented > threshold, STATUS_GOOD), (oriented < -threshold, STATUS_REVIEW)],
                       STATUS_STABLE)


def kpi_health(fact: DataFrame, metric_dim: DataFrame | None = None,
               cfg: HealthConfig = HealthConfig(), keep_polarity: bool = False) -> DataFrame:
    """HLT: fact(month, asset_name, metric_name, metric_value) -> health contract columns."""
    base = fact.select("month", *SERIES, "metric_value")
    df = seasonal_stats(lags_and_rolling(base, cfg))
    df = with_polarity(df, metric_dim, cfg.default_polarity)
    v = F.col("metric_value")
    df = df.withColumns({
        "deviation_from_rolling_avg": guarded_relative_deviation(v, F.col("rolling_12m_avg")),
        "seasonal_z_score": safe_z(v, F.col("seasonal_mean"), F.col("seasonal_std"),
                                   F.col("seasonal_count"), cfg.min_season_history),
        "trend_direction": trend(v, F.col("prior_month_value")),
    })
    df = df.withColumn("health_status", health_status(F.col("deviation_from_rolling_avg"),
                                                      F.col("polarity"), cfg.threshold))
    cols = list(HEALTH_COLUMNS) + (["polarity"] if keep_polarity else [])
    return df.select(*cols)
