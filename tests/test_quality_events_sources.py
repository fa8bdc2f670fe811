import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiloom.operators.events import event_windows
from kpiloom.operators.quality import QualityConfig, QualityGateError, quality_checks, quality_gate
from kpiloom.session import scratch_path
from kpiloom.sources.config_json import metric_dim_from_json, weights_from_json
from kpiloom.sources.ingest import read_raw
from kpiloom.sources.sinks import write_table

M1, M2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
FACT = "month date, asset_name string, metric_name string, metric_value double"
BFACT = "month date, asset_name string, metric_name string, metric_value double, club string"


def clean(spark):
    i = spark.createDataFrame([(m, "a", k, 0.5) for m in (M1, M2) for k in ("bounce_rate", "visits")], FACT)
    b = spark.createDataFrame([(m, "a", "visits", 1.0, f"c{c}") for m in (M1, M2) for c in range(5)], BFACT)
    return i, b


def by_check(df):
    return {(r.table_name, r.check_name): (r.status, r.issue_count) for r in df.collect()}


def test_clean_input_passes_every_check(spark):
    i, b = clean(spark)
    res = by_check(quality_checks(i, b, "r1", "i", "b"))
    assert len(res) == 7 and all(v == ("PASS", 0) for v in res.values())


def test_seeded_bad_input_fails_each_check(spark):
    i, b = clean(spark)
    bad_i = i.unionByName(spark.createDataFrame([
        (M1, "a", "visits", 0.7),                 # duplicate key
        (None, "a", "visits", 1.0),               # null month (also breaks coverage)
        (M2, "a", "bounce_rate", float("nan")),   # NaN rate (+ duplicate)
        (M1, "a", "x_rate", None),                # null value, new series with one month
        (M1, "a", "conversion_rate", 1.5),        # out of bounds
    ], FACT))
    bad_b = b.unionByName(spark.createDataFrame([(M1, "a", "visits", 2.0, "c0")], BFACT)).filter(
        ~((F.col("month") == M2) & (F.col("club") == "c4")))
    res = by_check(quality_checks(bad_i, bad_b, "r2", "i", "b"))
    assert res[("i", "No null months")] == ("FAIL", 1)
    assert res[("i", "No null metric values")] == ("FAIL", 1)
    assert res[("i", "No duplicate keys on (month, asset_name, metric_name)")] == ("FAIL", 2)
    assert res[("i", "Rate metrics bounded between 0 and 1")] == ("FAIL", 2)
    assert res[("i", "Complete monthly coverage by asset+metric")] == ("FAIL", 4)
    assert res[("b", "No duplicate keys on (month, asset_name, metric_name, club)")] == ("FAIL", 1)
    assert res[("b", "Exactly 5 benchmark clubs per month+asset+metric")] == ("FAIL", 1)


def test_gate_logs_before_raising(spark):
    i, b = clean(spark)
    bad_i = i.unionByName(spark.createDataFrame([(None, "a", "visits", 1.0)], FACT))
    log = scratch_path(spark, "test_log")
    quality_gate(quality_checks(i, b, "ok"), log)
    with pytest.raises(QualityGateError, match="No null months"):
        quality_gate(quality_checks(bad_i, b, "bad"), log)
    runs = {r.run_id: r.n for r in spark.read.parquet(log).groupBy("run_id").agg(F.count("*").alias("n")).collect()}
    assert runs == {"ok": 7, "bad": 7}


def test_event_windows_baseline_and_absent_offsets(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 8)]
    series = spark.createDataFrame([(d, "buy", "v", float(i + 1)) for i, d in enumerate(days) if i != 5],
                                   "day date, asset_name string, metric_name string, metric_value double")
    ann = spark.createDataFrame([(1, dt.date(2024, 1, 4), "buy")], "event_id long, event_day date, asset_name string")
    out = {r.period_offset: r for r in event_windows(series, ann, 3, 3).collect()}
    assert sorted(out) == [-3, -2, -1, 0, 1, 3]            # offset +2 has no data
    assert out[0].baseline == 2.0 and out[0].deviation == 1.0


def test_month_unit(spark):
    series = spark.createDataFrame([(M1, "a", "v", 1.0), (M2, "a", "v", 3.0)],
                                   "month date, asset_name string, metric_name string, metric_value double")
    ann = spark.createDataFrame([(7, M2, "a")], "event_id long, event_month date, asset_name string")
    out = event_windows(series, ann, 1, 0, unit="month", series_period="month", event_period="event_month").collect()
    assert {(r.period_offset, r.deviation) for r in out} == {(-1, 0.0), (0, 2.0)}


def test_json_dictionary_and_weights(spark, tmp_path):
    p = tmp_path / "dict.json"
    p.write_text('{\n "visits": {"polarity": 1, "commercial_weight": 0.5},\n "bounce_rate": {"polarity": -1}\n}\n')
    dim = {r.metric_name: (r.polarity, r.commercial_weight) for r in metric_dim_from_json(spark, str(p)).collect()}
    assert dim == {"visits": (1, 0.5), "bounce_rate": (-1, None)}
    w = tmp_path / "scoring.json"
    w.write_text('{"formula_weights": {"severity": 0.2, "persistence": 0.2, "peer_gap": 0.2, '
                 '"commercial": 0.2, "evidence": 0.2}}')
    assert weights_from_json(spark, str(w)).severity == 0.2
    assert weights_from_json(spark, None).severity == 0.3


def test_csv_ingest_lineage_and_observed_write(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "sheet.csv").write_text("month,visits\n2024-01-01,5\n2024-02-01,7\n")
    df = read_raw(spark, str(src), "csv", "month date, visits double")
    rows = df.collect()
    assert {r.source_file_name for r in rows} == {"sheet.csv"} and all(r.ingestion_timestamp for r in rows)
    n = write_table(df, scratch_path(spark, "test_write"))
    assert n == 2


def test_quality_scans_each_fact_once(spark, tmp_path):
    i, b = clean(spark)
    i.write.parquet(str(tmp_path / "i"))
    b.write.parquet(str(tmp_path / "b"))
    i, b = spark.read.parquet(str(tmp_path / "i")), spark.read.parquet(str(tmp_path / "b"))
    cfg = QualityConfig(benchmark_conditions=(("No null clubs", "club IS NOT NULL"),))
    plan = quality_checks(i, b, "r", cfg=cfg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert len(by_check(quality_checks(i, b, "r", cfg=cfg))) == 8
    other = QualityConfig(internal_keys=("month", "asset_name"))
    res = by_check(quality_checks(i, b, "r", "i", "b", cfg=other))
    assert res[("i", "No duplicate keys on (month, asset_name)")] == ("FAIL", 2)
    assert quality_checks(i, b, "r", cfg=other)._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3


def test_quality_of_empty_facts(spark):
    i, b = clean(spark)
    res = by_check(quality_checks(i.limit(0), b.limit(0), "r", "i", "b"))
    assert len(res) == 7 and all(v == ("PASS", 0) for v in res.values())


def test_a_retried_run_is_logged_once(spark):
    i, b = clean(spark)
    log = scratch_path(spark, "retry_log")
    for _ in range(3):
        quality_gate(quality_checks(i, b, "run1"), log)
    quality_gate(quality_checks(i, b, "run2"), log)
    runs = {r.run_id: r.n for r in spark.read.parquet(log).groupBy("run_id").agg(F.count("*").alias("n")).collect()}
    assert runs == {"run1": 7, "run2": 7}


def test_dynamic_overwrite_leaves_other_partitions(spark):
    target = scratch_path(spark, "dynamic")
    rows = [(p, k, 0) for p in ("a", "b", "c") for k in range(50)]
    df = spark.createDataFrame(rows, "p string, k int, v int").repartition(8)
    assert write_table(df, target, partition_by=("p",)) == 150
    files = lambda: {(r.p, r.f) for r in spark.read.parquet(target).select("p", F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    assert len(before) == 3                                 # one file per partition, not one per task
    assert write_table(df.where("p = 'b' and k < 5").withColumn("v", F.lit(1)), target, partition_by=("p",), only_given_partitions=True) == 5
    got = {r.p: (r.n, r.v) for r in spark.read.parquet(target).groupBy("p").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()}
    assert got == {"a": (50, 0), "b": (5, 5), "c": (50, 0)}
    assert {x for x in files() if x[0] != "b"} == {x for x in before if x[0] != "b"} and not ({x for x in files() if x[0] == "b"} & before)
    with pytest.raises(ValueError):
        write_table(df, target, only_given_partitions=True)


def test_bad_weights_file(spark, tmp_path):
    for text in ("{not json", '{"formula_weights": {"severity": 0.5}}', "{}"):
        p = tmp_path / f"w{len(text)}.json"
        p.write_text(text)
        with pytest.raises(Exception, match="MALFORMED|without"):
            weights_from_json(spark, str(p))
