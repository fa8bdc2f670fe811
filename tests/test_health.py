import datetime as dt

from pyspark.sql import functions as F

from kpiloom.config import HealthConfig
from kpiloom.operators.health import kpi_health
from kpiloom.sources.config_json import metric_dim_from_dict


def months(n, start=2020):
    return [dt.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def fact(spark, values, metric="visits", asset="web", dates=None):
    dates = dates or months(len(values))
    return spark.createDataFrame([(d, asset, metric, float(v)) for d, v in zip(dates, values)],
                                 "month date, asset_name string, metric_name string, metric_value double")


def test_trend_and_prior_null(spark):
    out = kpi_health(fact(spark, [10, 12, 12, 9])).orderBy("month").collect()
    assert [r.trend_direction for r in out] == ["flat", "up", "flat", "down"]
    assert out[0].prior_month_value is None and out[1].prior_month_value == 10.0


def test_rolling_and_deviation(spark):
    out = kpi_health(fact(spark, [10, 20])).orderBy("month").collect()
    assert out[1].rolling_12m_avg == 15.0
    assert abs(out[1].deviation_from_rolling_avg - (20 - 15) / 15) < 1e-12
    assert out[0].health_status == "stable" and out[1].health_status == "good"


def test_zero_rolling_mean_gives_null_deviation(spark):
    out = kpi_health(fact(spark, [0, 0])).collect()
    assert all(r.deviation_from_rolling_avg is None and r.health_status == "stable" for r in out)


def test_seasonal_z_needs_two_history_rows_and_spread(spark):
    # January values over four years: 10, 20, 30, 100 -> the last January has history (10, 20, 30)
    dates = [dt.date(2020 + i, 1, 1) for i in range(4)]
    out = kpi_health(fact(spark, [10, 20, 30, 100], dates=dates)).orderBy("month").collect()
    assert [r.seasonal_z_score for r in out[:2]] == [0.0, 0.0]
    assert abs(out[2].seasonal_z_score - (30 - 15) / (50 ** 0.5)) < 1e-12
    assert abs(out[3].seasonal_z_score - (100 - 20) / 10.0) < 1e-12
    flat = kpi_health(fact(spark, [5, 5, 5], dates=dates[:3])).collect()
    assert all(r.seasonal_z_score == 0.0 for r in flat)


def test_polarity_negative_and_neutral(spark):
    dim = metric_dim_from_dict(spark, {"bounce_rate": (-1, 0.5), "pct_android": (0, 0.1)})
    up = fact(spark, [1, 2], metric="bounce_rate").unionByName(fact(spark, [1, 2], metric="pct_android"))
    out = {r.metric_name: r.health_status for r in kpi_health(up, dim).filter(F.month("month") == 2).collect()}
    assert out == {"bounce_rate": "review", "pct_android": "stable"}


def test_lag_is_by_row_unless_calendar(spark):
    dates = months(14)
    dates = dates[:5] + dates[6:]          # one missing month -> 13 rows
    vals = list(range(1, 14))
    rows = kpi_health(fact(spark, vals, dates=dates)).orderBy("month").collect()
    cal = kpi_health(fact(spark, vals, dates=dates), cfg=HealthConfig(calendar=True)).orderBy("month").collect()
    # row after the gap: row mode sees the previous row, calendar mode sees no previous month
    assert rows[5].prior_month_value == 5.0 and cal[5].prior_month_value is None
    # last row: 12 rows back (row mode) vs exactly 12 months back (calendar)
    assert rows[12].prior_season_same_month_value == 1.0
    assert cal[12].prior_season_same_month_value == 2.0


def test_calendar_equals_rows_on_gap_free_data(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9]
    a = kpi_health(fact(spark, vals)).orderBy("month").collect()
    b = kpi_health(fact(spark, vals), cfg=HealthConfig(calendar=True)).orderBy("month").collect()
    assert a == b


def test_single_exchange_for_both_windows(spark):
    plan = kpi_health(fact(spark, [1, 2, 3]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in plan
