import datetime as dt
import math

import pytest

from kpiloom.operators.normalize import clean_columns, normalize, normalize_sheets, unpivot_to_fact


def test_clean_headers_and_typos(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Net.Sales` int, `%Android` int, `Unique Visitors` int")
    out = clean_columns(df, {"%android": "pct_android"})
    assert out.columns == ["net_sales", "pct_android", "unique_visitors"]


def test_header_collision_rejected(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a.b` int")
    with pytest.raises(ValueError):
        clean_columns(df)


def test_unpivot_casts_and_drops_null_and_nan(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 5, 0.5), ("2024-02-01", None, float("nan"))], "month string, visits long, bounce_rate double")
    fact = normalize(df, ids=("month", "asset_name", "asset_type"), allowlist={"visits", "bounce_rate"},
                     asset_name="main_website", asset_type="web", source_type="internal", with_category=True)
    rows = sorted((r.month, r.metric_name, r.metric_value, r.metric_category) for r in fact.collect())
    assert rows == [(dt.date(2024, 1, 1), "bounce_rate", 0.5, "quality"), (dt.date(2024, 1, 1), "visits", 5.0, "volume")]
    assert dict(fact.dtypes)["metric_value"] == "double"
    assert {r.asset_name for r in fact.collect()} == {"main_website"}


def test_allowlist_prunes_and_labels_dropped(spark):
    df = spark.createDataFrame([("2024-01-01", "x", "y", 1.0, 2.0)],
                               "month string, digital_active string, active_type string, visits double, junk double")
    fact = normalize(df, ids=("month", "asset_name"), allowlist={"visits"}, asset_name="a")
    assert {r.metric_name for r in fact.collect()} == {"visits"}
    assert "digital_active" not in fact.columns and "active_type" not in fact.columns


def test_no_measures_gives_typed_empty(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0)], "month string, junk double")
    fact = normalize(df, ids=("month", "asset_name"), allowlist={"visits"}, asset_name="a", with_category=True)
    assert fact.count() == 0
    assert dict(fact.dtypes)["metric_value"] == "double"
    assert "metric_category" in fact.columns


def test_sheets_union_by_name(spark):
    a = spark.createDataFrame([("2024-01-01", 1.0)], "month string, visits double")
    b = spark.createDataFrame([(2.0, "2024-01-01")], "visits double, month string")
    fact = normalize_sheets([(a, "web", "web"), (b, "app", "app")], ids=("month", "asset_name", "asset_type"))
    assert sorted((r.asset_name, r.metric_value) for r in fact.collect()) == [("app", 2.0), ("web", 1.0)]


def test_unpivot_is_narrow(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0, 2.0)], "month string, a double, b double")
    plan = unpivot_to_fact(df, ("month",), None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_without_allowlist_only_numeric_columns_are_measures(spark):
    df = spark.createDataFrame([("2024-01-01", "x", 3, 1.5)], "month string, label string, visits int, rate double")
    fact = unpivot_to_fact(df, ("month",), None)
    assert sorted(r.metric_name for r in fact.collect()) == ["rate", "visits"]
