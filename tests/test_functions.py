import random

from pyspark.sql import functions as F

from kpiloom.functions import pearson, split_mean


def test_split_mean_is_partitioning_independent(spark):
    rnd = random.Random(1)
    vals = [rnd.uniform(-1e7, 1e7) for _ in range(2000)] + [rnd.uniform(0, 1) for _ in range(2000)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(vals)], "g int, v double")
    results = set()
    for parts in (1, 3, 11, 64):
        shuffled = df.repartition(parts).orderBy(F.rand(parts))
        rows = shuffled.groupBy("g").agg(split_mean(F.col("v")).alias("m")).orderBy("g").collect()
        results.add(tuple(r.m for r in rows))
    assert len(results) == 1
    exact = {g: sum(v for i, v in enumerate(vals) if i % 7 == g) / len([1 for i in range(len(vals)) if i % 7 == g])
             for g in range(7)}
    got = dict(enumerate(next(iter(results))))
    assert all(abs(got[g] - exact[g]) <= 1e-9 * max(1.0, abs(exact[g])) for g in range(7))


def test_split_mean_window_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (1, 4.0), (2, None)], "g int, v double")
    from pyspark.sql import Window
    out = {(r.g, r.v): r.m for r in df.select("g", "v", split_mean(F.col("v"), Window.partitionBy("g")).alias("m")).collect()}
    assert out[(1, 2.0)] == 3.0 and out[(2, None)] is None


def test_pearson_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.agg(pearson("x", "y").alias("c")).first().c is None


def test_sized_broadcast_hints_small_and_skips_large(spark):
    from kpiloom.functions import sized_broadcast
    from kpiloom.sources.config_json import literal_rows

    small = literal_rows(spark, [("a", 1)], "k string, v int")
    big = spark.range(10_000_000).withColumnRenamed("id", "v")
    plan_small = spark.range(5).join(sized_broadcast(small), F.col("id") == F.col("v"))
    assert "ResolvedHint" in plan_small._jdf.queryExecution().analyzed().toString() or \
        "BroadcastHashJoin" in plan_small._jdf.queryExecution().executedPlan().toString()
    assert sized_broadcast(big, limit_bytes=1024) is big
