import datetime as dt
import random
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiloom.config import PeerConfig
from kpiloom.operators.peers import peer_benchmark, peer_stats, value_bin
from kpiloom.sources.config_json import metric_dim_from_dict

M = dt.date(2024, 1, 1)
FACT = "month date, asset_name string, metric_name string, metric_value double"
PEERS = "month date, asset_name string, metric_name string, peer_value double, club string"


def subject(spark, v, metric="visits", month=M):
    return spark.createDataFrame([(month, "web", metric, float(v))], FACT)


def peers(spark, values, metric="visits", month=M):
    return spark.createDataFrame([(month, "web", metric, float(v), f"c{i}") for i, v in enumerate(values)], PEERS)


def test_stats_rank_gap_leader(spark):
    b = peer_benchmark(subject(spark, 25), peers(spark, [10, 20, 30, 40, 50])).collect()[0]
    assert (b.peer_median, b.peer_mean, b.peer_leader_value, b.club_count) == (30.0, 30.0, 50.0, 5)
    assert b.subject_rank == 4 and b.gap_to_peer_median == -5.0 and b.gap_to_leader == -25.0


def test_even_count_median_is_lower_middle(spark):
    b = peer_benchmark(subject(spark, 1), peers(spark, [1, 2, 3, 4, 5, 6])).collect()[0]
    assert b.peer_median == 3.0


def test_coverage_threshold(spark):
    assert peer_benchmark(subject(spark, 1), peers(spark, [1, 2, 3, 4])).count() == 0
    assert peer_benchmark(subject(spark, 1), peers(spark, [1, 2, 3, 4]), cfg=PeerConfig(min_clubs=4)).count() == 1


def test_negative_polarity_mirrors(spark):
    dim = metric_dim_from_dict(spark, {"bounce_rate": (-1, 0.5)})
    b = peer_benchmark(subject(spark, 0.2, "bounce_rate"), peers(spark, [0.1, 0.3, 0.4, 0.5, 0.6], "bounce_rate"),
                       dim).collect()[0]
    assert b.subject_rank == 2 and b.peer_leader_value == 0.1
    assert abs(b.gap_to_peer_median - 0.2) < 1e-12     # -(0.2 - 0.4): ahead of the median


def test_ties_share_rank(spark):
    b = peer_benchmark(subject(spark, 30), peers(spark, [30, 30, 40, 10, 20])).collect()[0]
    assert b.subject_rank == 2


def test_count_rank_equals_window_rank(spark):
    rnd = random.Random(7)
    rows_s, rows_p = [], []
    for g in range(60):
        pol_metric = ["up", "down", "flat"][g % 3]
        m = dt.date(2020 + g // 12, g % 12 + 1, 1)
        rows_s.append((m, "a", pol_metric, float(rnd.randint(0, 5))))
        rows_p += [(m, "a", pol_metric, float(rnd.randint(0, 5)), f"c{i}") for i in range(rnd.randint(5, 9))]
    s, p = spark.createDataFrame(rows_s, FACT), spark.createDataFrame(rows_p, PEERS)
    dim = metric_dim_from_dict(spark, {"up": (1, None), "down": (-1, None), "flat": (0, None)})
    got = {(r.month, r.metric_name): r.subject_rank for r in peer_benchmark(s, p, dim).collect()}
    pol = F.when(F.col("metric_name") == "down", -1).when(F.col("metric_name") == "flat", 0).otherwise(1)
    base = p.select("month", "metric_name", (F.col("peer_value") * pol).alias("adj"), F.lit(0).alias("is_s")).unionByName(
        s.select("month", "metric_name", (F.col("metric_value") * pol).alias("adj"), F.lit(1).alias("is_s")))
    w = Window.partitionBy("month", "metric_name").orderBy(F.col("adj").desc())
    want = {(r.month, r.metric_name): r.r for r in
            base.withColumn("r", F.rank().over(w)).filter("is_s = 1").collect()}
    assert got == want


def test_twelve_row_changes(spark):
    months = [dt.date(2020 + i // 12, i % 12 + 1, 1) for i in range(13)]
    s = spark.createDataFrame([(m, "web", "visits", 25.0 if i == 12 else 5.0) for i, m in enumerate(months)], FACT)
    p = spark.createDataFrame([(m, "web", "visits", float(v), f"c{v}") for m in months for v in (10, 20, 30, 40, 50)],
                              PEERS)
    last = peer_benchmark(s, p).orderBy("month").collect()[-1]
    assert last.rank_change_12m == 6 - 4 and last.gap_change_12m == (25 - 30) - (5 - 30)


def test_extra_source_optional(spark):
    extra = spark.createDataFrame(
        [(M, "me", 5.0)] + [(M, f"p{i}", float(i)) for i in range(5)], "month date, club_name string, likes double")
    b = peer_benchmark(subject(spark, 10), peers(spark, [1, 2, 3, 4, 5]), extra=extra, extra_subject="me",
                       extra_asset="social_media", extra_measures=("likes",))
    rows = {r.asset_name: r.subject_rank for r in b.collect()}
    assert rows == {"web": 1, "social_media": 1}
    assert peer_benchmark(subject(spark, 1), peers(spark, [1, 2, 3, 4, 5])).count() == 1


def test_histogram_bins_ascend_and_ranks_are_exact(spark):
    rnd = random.Random(5)
    values = sorted([0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, float("inf"), float("-inf"), 5.0, 5.0, 5.000001] +
                    [rnd.choice([1, -1]) * 10 ** rnd.uniform(-6, 6) for _ in range(300)])
    df = spark.createDataFrame([(v,) for v in [*values, float("nan")]], "x double").coalesce(1)
    bins = [r.b for r in df.select(value_bin(F.col("x"), 64).alias("b")).collect()]
    assert bins == sorted(bins)
    for bins_per_doubling in (1, 64):
        s = spark.createDataFrame([(M, "web", f"m{i}", v) for i, v in enumerate(values[::20])], FACT)
        p = spark.createDataFrame([(M, "web", f"m{i}", v, f"c{k}") for i in range(len(values[::20])) for k, v in enumerate(values)], PEERS)
        got = {r.metric_name: r.subject_rank for r in peer_stats(s, p, cfg=PeerConfig(bins_per_doubling=bins_per_doubling)).collect()}
        assert got == {f"m{i}": 1 + sum(x > v for x in values) for i, v in enumerate(values[::20])}


def test_peers_are_dealt_by_value_and_bin(spark):
    plan = peer_stats(subject(spark, 1), peers(spark, [1, 2, 3, 4, 5]))._jdf.queryExecution().executedPlan().toString()
    keyed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("peer_value#" in k for k in keyed) and any("bin#" in k for k in keyed)      # by value, and by bin


def test_stats_need_one_aggregate_no_window_sort(spark):
    plan = peer_stats(subject(spark, 1), peers(spark, [1, 2, 3, 4, 5]))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
