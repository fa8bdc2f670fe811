"""Metamorphic relations between equivalent formulations."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiloom.functions import pearson
from kpiloom.operators.health import kpi_health
from kpiloom.operators.peers import peer_benchmark
from kpiloom.operators.signals import lag_correlations, metric_pivot
from kpiloom.sources.config_json import metric_dim_from_dict

FACT = "month date, asset_name string, metric_name string, metric_value double"
PEERS = "month date, asset_name string, metric_name string, peer_value double, club string"


def months(n):
    return [dt.date(2015 + i // 12, i % 12 + 1, 1) for i in range(n)]


def test_negative_polarity_mirrors_health(spark):
    rnd = random.Random(3)
    rows = [(m, "a", "x", float(rnd.randint(50, 150))) for m in months(30)]
    fact = spark.createDataFrame(rows, FACT)
    up = {r.month: r.health_status for r in kpi_health(fact, metric_dim_from_dict(spark, {"x": (1, None)})).collect()}
    down = {r.month: r.health_status for r in kpi_health(fact, metric_dim_from_dict(spark, {"x": (-1, None)})).collect()}
    swap = {"good": "review", "review": "good", "stable": "stable"}
    assert down == {m: swap[s] for m, s in up.items()}
    assert set(up.values()) >= {"good", "review"}


def test_negative_polarity_equals_negated_data_for_rank(spark):
    rnd = random.Random(5)
    s_rows, p_rows = [], []
    for m in months(12):
        s_rows.append((m, "a", "x", float(rnd.randint(0, 9))))
        p_rows += [(m, "a", "x", float(rnd.randint(0, 9)), f"c{i}") for i in range(6)]
    s, p = spark.createDataFrame(s_rows, FACT), spark.createDataFrame(p_rows, PEERS)
    neg = lambda df, c: df.withColumn(c, -F.col(c))
    a = {r.month: r.subject_rank for r in peer_benchmark(s, p, metric_dim_from_dict(spark, {"x": (-1, None)})).collect()}
    b = {r.month: r.subject_rank for r in peer_benchmark(neg(s, "metric_value"), neg(p, "peer_value")).collect()}
    assert a == b


def test_lag_join_equals_pivot_and_lead(spark):
    rnd = random.Random(11)
    ms = months(40)
    ms = [m for i, m in enumerate(ms) if i not in (7, 21)]            # gaps in every series
    rows = [(m, "app", "heavy", float(rnd.randint(0, 50))) for m in ms]
    rows += [(m, "shop", "sales", float(rnd.randint(0, 50))) for i, m in enumerate(ms) if i % 9 != 4]
    fact = spark.createDataFrame(rows, FACT)
    got = {r.lag_months: (r.n_pairs, r.strength_score)
           for r in lag_correlations(fact, (("app", "heavy", "{}"),), (("shop", "sales"),)).collect()}
    wide = metric_pivot(fact, [("app", "heavy"), ("shop", "sales")])
    w = Window.orderBy("month")                                        # the formulation being replaced
    for lag in (1, 2, 3):
        pair = wide.select("app_heavy", F.lead("shop_sales", lag).over(w).alias("y")).dropna()
        want = pair.agg(F.count(F.lit(1)).alias("n"), pearson("app_heavy", "y").alias("c")).first()
        assert got[lag][0] == want.n
        assert abs(got[lag][1] - want.c) < 1e-12
