import datetime as dt
import math

from kpiloom.config import SignalConfig
from kpiloom.operators.signals import discover_signals, lag_correlations, metric_pivot

FACT = "month date, asset_name string, metric_name string, metric_value double"


def months(n):
    return [dt.date(2010 + i // 12, i % 12 + 1, 1) for i in range(n)]


def series(spark, xs, ys, lag=1):
    ms = months(len(xs))
    rows = [(m, "app", "heavy", float(x)) for m, x in zip(ms, xs)]
    rows += [(m, "shop", "sales", float(y)) for m, y in zip(ms, ys)]
    return spark.createDataFrame(rows, FACT)


CANDS = (("app", "heavy", "Heavy users lead {}."),)
TGTS = (("shop", "sales"),)


def test_lead_alignment_and_perfect_correlation(spark):
    xs = [1, 5, 2, 8, 3, 9, 4, 7, 6, 10, 2, 5, 8, 1, 3, 9]
    ys = [0] + [2 * x + 1 for x in xs[:-1]]           # sales(t+1) = 2*heavy(t) + 1
    corr = {r.lag_months: r for r in lag_correlations(series(spark, xs, ys), CANDS, TGTS).collect()}
    assert corr[1].n_pairs == 15 and abs(corr[1].strength_score - 1.0) < 1e-12
    sig = discover_signals(series(spark, xs, ys), CANDS, TGTS, SignalConfig()).collect()
    assert sig[0].lag_months == 1 and sig[0].relationship_direction == "positive"
    assert sig[0].business_interpretation == "Heavy users lead shop sales."
    assert sig[0].last_validated_month == months(16)[-1]


def test_min_pairs_is_strict(spark):
    xs = list(range(13))
    ys = [0] + [x * 3 for x in xs[:-1]]
    # lag 1 gives 12 aligned months: not more than 12 -> no signal
    assert discover_signals(series(spark, xs, ys), CANDS, TGTS, SignalConfig(lags=(1,))).count() == 0
    xs, ys = list(range(14)), [0] + [x * 3 for x in range(13)]
    assert discover_signals(series(spark, xs, ys), CANDS, TGTS, SignalConfig(lags=(1,))).count() == 1


def test_zero_variance_is_null_not_error(spark):
    xs, ys = [5] * 20, list(range(20))
    corr = lag_correlations(series(spark, xs, ys), CANDS, TGTS).collect()
    assert all(r.strength_score is None for r in corr)
    assert discover_signals(series(spark, xs, ys), CANDS, TGTS).count() == 0


def test_shift_is_by_distinct_month_position(spark):
    # a gap in every series: positions still step over the months present
    ms = months(20)
    ms = ms[:10] + ms[11:]
    xs = [1, 4, 2, 8, 5, 7, 3, 9, 6, 2, 4, 8, 1, 5, 7, 3, 9, 2, 6]
    rows = [(m, "app", "heavy", float(x)) for m, x in zip(ms, xs)]
    rows += [(m, "shop", "sales", float(xs[i - 1]) if i else 0.0) for i, m in enumerate(ms)]
    corr = {r.lag_months: r for r in lag_correlations(spark.createDataFrame(rows, FACT), CANDS, TGTS).collect()}
    assert abs(corr[1].strength_score - 1.0) < 1e-12 and corr[1].n_pairs == 18


def test_top_k_and_negative_direction(spark):
    xs = [1, 5, 2, 8, 3, 9, 4, 7, 6, 10, 2, 5, 8, 1, 3, 9]
    ys = [0] + [-x for x in xs[:-1]]
    sig = discover_signals(series(spark, xs, ys), CANDS, TGTS, SignalConfig(min_abs_corr=0.0, top_k=2)).collect()
    assert len(sig) == 2 and sig[0].relationship_direction == "negative" and sig[0].lag_months == 1


def test_pivot_explicit_values(spark):
    df = series(spark, [1, 2], [3, 4])
    p = metric_pivot(df, [("app", "heavy"), ("shop", "sales")]).orderBy("month").collect()
    assert [(r.app_heavy, r.shop_sales) for r in p] == [(1.0, 3.0), (2.0, 4.0)]


def test_one_plan_no_python(spark):
    plan = discover_signals(series(spark, list(range(20)), list(range(20))), CANDS, TGTS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
