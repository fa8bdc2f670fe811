import math

from pyspark.sql import functions as F

from kpiloom.functions.json_text import Many, Record, json_text, json_type, number, number_text, text, whole
from kpiloom.operators.contracts import EVIDENCE
from kpiloom.plans.oracle import record_sql


def test_numbers(spark):
    values = [0.0, -0.0, 0.55, -0.0025, 100.0, 1e-7, 1e-30, 123456.789012345, 1e15, 1e18, 3.0, 2.5e25, float("nan"), math.inf, -math.inf, None, -1e-30]
    want = ["0", "0", "0.55", "-0.0025", "100", "0.0000001", "0", "123456.789012", "1000000000000000", "1000000000000000000", "3",
            "2.50000000000e+25", None, None, None, None, "0"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert [r.t for r in df.orderBy("i").select(number_text(F.col("x")).alias("t")).collect()] == want
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_nulls_lists_and_escapes(spark):
    contract = Record({"b": text("name"), "a": Record({"n": whole("n"), "x": number("x")}), "p": Record({"y": number("y")}, source="s"),
                       "l": Many("items", Record({"t": text("t"), "z": number("z")}))})
    schema = "name string, n int, x double, s struct<y: double>, items array<struct<t: string, z: double>>"
    rows = [('q"\\/é\n', 1, 0.5, (2.0,), [("a", None), (None, 1.5)]), (None, None, None, None, []), ("", 2, None, (None,), None)]
    df = spark.createDataFrame(rows, schema).select("*", json_text(contract).alias("j"))
    got = [r.j for r in df.collect()]
    assert got == ['{"b":"q\\"\\\\/é\\n","a":{"n":1,"x":0.5},"p":{"y":2},"l":[{"t":"a"},{"z":1.5}]}', '{"a":{},"l":[]}', '{"b":"","a":{"n":2},"p":{}}']
    back = df.select(F.from_json("j", json_type(contract), {"mode": "FAILFAST"}).alias("v")).collect()
    assert back[0].v.b == rows[0][0] and back[0].v.l[1].z == 1.5 and back[1].v.p is None


def test_same_text_in_sql(spark):
    import duckdb
    contract = Record({"s": text("s"), "n": whole("n"), "x": number("x")})
    rows = [("a\"b\\\té", 5, 0.1 + 0.2), (None, None, 1e-9), ("", -3, -98765.4321), ("x", 0, float("nan"))]
    spark_text = [r.j for r in spark.createDataFrame(rows, "s string, n long, x double").coalesce(1).select(json_text(contract).alias("j")).collect()]
    con = duckdb.connect()
    con.execute("create table t (s varchar, n bigint, x double)")
    con.executemany("insert into t values (?, ?, ?)", rows)
    assert spark_text == [r[0] for r in con.execute(f"select {record_sql(contract)} from t").fetchall()]


def test_every_payload_field_is_in_the_contract():
    assert list(EVIDENCE.fields) == ["score_components", "severity_inputs", "persistence_inputs", "peer_context",
                                     "linked_signal_references", "supporting_metric_rows"]
    assert json_type(EVIDENCE.fields["peer_context"]).startswith("struct<peer_rank: bigint, peer_club_count: bigint, peer_median: double")
