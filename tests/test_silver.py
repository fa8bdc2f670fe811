import datetime as dt

from kpiloom.operators.silver import BENCHMARK, INTERNAL, Sheet, SilverContract, normalize_benchmark, normalize_internal, silver_rejects, wide_sheet
from kpiloom.sources.tables import optional_source


def sheets(spark):
    web = spark.createDataFrame([("2024-01-01", 5, 0.5, "junk", "main_website"), ("2024-02-01", None, float("nan"), "x", None)],
                                "Month string, `Unique Visitors` int, `Bounce.Rate` double, note string, `Digital Active` string")
    app = spark.createDataFrame([(dt.date(2024, 1, 1), " 7 ", "a.xlsx"), (dt.date(2024, 2, 1), "n/a", "a.xlsx"), (None, "3", "a.xlsx")],
                                "month date, heavy_users string, source_file_name string")
    odd = spark.createDataFrame([("soon", 1.0, 2), ("2024-03", 4.0, 5), (None, 6.0, 7)], "MONTH string, `%Android` double, `Otherl Traffic Plays` long")
    return [Sheet(web, "main_website", "web"), Sheet(app, "fan_app", "app"), Sheet(odd, "streaming", "streaming")]


def test_sheets_are_reconciled(spark):
    fact = normalize_internal(sheets(spark))
    assert fact.columns == list(INTERNAL.columns)
    assert dict(fact.dtypes) == {"month": "date", "asset_name": "string", "asset_type": "string", "source_file_name": "string",
                                 "ingestion_timestamp": "timestamp", "metric_name": "string", "metric_value": "double",
                                 "source_type": "string", "metric_category": "string"}
    got = sorted((str(r.month), r.asset_name, r.metric_name, r.metric_value, r.metric_category) for r in fact.collect())
    assert got == [("2024-01-01", "fan_app", "heavy_users", 7.0, "volume"), ("2024-01-01", "main_website", "bounce_rate", 0.5, "quality"),
                   ("2024-01-01", "main_website", "unique_visitors", 5.0, "volume"), ("2024-03-01", "streaming", "other_traffic_plays", 5.0, "volume"),
                   ("2024-03-01", "streaming", "pct_android", 4.0, "volume"), ("None", "fan_app", "heavy_users", 3.0, "volume"),
                   ("None", "streaming", "other_traffic_plays", 7.0, "volume"), ("None", "streaming", "pct_android", 6.0, "volume")]
    assert {(r.asset_name, r.source_file_name) for r in fact.collect()} == {("main_website", None), ("fan_app", "a.xlsx"), ("streaming", None)}


def test_rejects_name_the_cell(spark):
    got = sorted((r.asset_name, r.column_name, r.raw_value, r.month_text, r.reason) for r in silver_rejects(sheets(spark), INTERNAL).collect())
    assert got == [("fan_app", "heavy_users", "n/a", "2024-02-01", "value is not a number"), ("streaming", "month", "soon", "soon", "month cannot be read")]


def test_nothing_is_lost(spark):
    """Every cell that holds something is in the fact or among the rejects (or in a row that is)."""
    mine = sheets(spark)
    facts, rejects = normalize_internal(mine).count(), silver_rejects(mine, INTERNAL).collect()
    filled = 2 + 3 + 6                      # NULL and NaN cells do not count
    in_bad_rows = 2 * sum(r.column_name == "month" for r in rejects)
    assert facts + in_bad_rows + sum(r.column_name != "month" for r in rejects) == filled


def test_month_formats_and_wide_table(spark):
    df = spark.createDataFrame([("01/2024", 1.0), ("2024-02-01", 2.0)], "month string, visits double")
    contract = SilverContract(INTERNAL.ids, ("visits",), "internal", month_formats=("MM/yyyy",))
    assert sorted(str(r.month) for r in normalize_internal([Sheet(df, "a", "b")], contract).collect()) == ["2024-01-01", "2024-02-01"]
    wide = wide_sheet(Sheet(df, "a", "b"), contract)
    assert wide.columns == [*contract.id_names, "visits"] and sorted(r.visits for r in wide.collect()) == [1.0, 2.0]


def test_no_sheet_has_a_measure(spark):
    df = spark.createDataFrame([("2024-01-01", "c", 1.0)], "month string, club string, junk double")
    fact = normalize_benchmark([Sheet(df, "a", "b")])
    assert fact.columns == list(BENCHMARK.columns) and fact.collect() == [] and silver_rejects([Sheet(df, "a", "b")], BENCHMARK).collect() == []
    both = [Sheet(df, "a", "b"), Sheet(df.withColumnRenamed("junk", "visits"), "c", "d")]
    assert [(r.club, r.asset_name, r.metric_value) for r in normalize_benchmark(both).collect()] == [("c", "c", 1.0)]


def test_facts_and_rejects_need_no_shuffle(spark):
    plan = normalize_internal(sheets(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_optional_source(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    assert optional_source(spark, None) is None and optional_source(spark, "no_such_view") is None
    assert optional_source(spark, str(tmp_path / "none")) is None
    df.createOrReplaceTempView("an_extra_view")
    df.write.parquet(str(tmp_path / "some"))
    assert optional_source(spark, "an_extra_view").count() == 1 and optional_source(spark, str(tmp_path / "some")).count() == 1
