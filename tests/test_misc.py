import datetime as dt

from kpiloom.config import HealthConfig
from kpiloom.operators.health import kpi_health
from kpiloom.operators.normalize import normalize
from kpiloom.session import cluster_conf


def test_lenient_month_turns_bad_strings_into_null(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0), ("not a date", 2.0)], "month string, visits double")
    fact = normalize(df, ids=("month", "asset_name"), allowlist={"visits"}, asset_name="a", lenient_month=True)
    assert sorted((r.month is None, r.metric_value) for r in fact.collect()) == [(False, 1.0), (True, 2.0)]


def test_calendar_rolling_mean_skips_missing_months(spark):
    # Jan..Dec 2020 = 1..12, then a 12-month gap, then Jan 2022 = 100
    rows = [(dt.date(2020, m, 1), "a", "x", float(m)) for m in range(1, 13)] + [(dt.date(2022, 1, 1), "a", "x", 100.0)]
    fact = spark.createDataFrame(rows, "month date, asset_name string, metric_name string, metric_value double")
    by_row = {r.month: r.rolling_12m_avg for r in kpi_health(fact).collect()}
    by_cal = {r.month: r.rolling_12m_avg for r in kpi_health(fact, cfg=HealthConfig(calendar=True)).collect()}
    assert by_row[dt.date(2022, 1, 1)] == (sum(range(2, 13)) + 100) / 12     # previous 11 rows + itself
    assert by_cal[dt.date(2022, 1, 1)] == 100.0                              # no month within 11 months


def test_cluster_conf_sizes_partitions_from_the_shuffle():
    conf = cluster_conf(6e12, executor_cores=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == int(6e12 // (256 * 1024 ** 2)) + 1
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(1e6, executor_cores=1000)["spark.sql.shuffle.partitions"]) == 2000
