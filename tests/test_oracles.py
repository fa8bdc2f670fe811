"""Driver-style check at sf0.001: registered Spark queries vs their DuckDB oracles."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from kpiloom.plans import registry

from conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SUBSET = ("fact_unpivot", "kpi_health", "kpi_health_calendar", "peer_rank_gap", "signals_top", "priority_scores",
          "priority_board", "brief_summaries_flat", "dq_results", "event_windows", "metric_dim_lookup",
          "normalize_internal", "normalize_rejects", "priority_board_json", "brief_inputs_json", "fact_month_rewrite")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_most_have_oracles():
    qs, sql = registry.queries(), registry.oracle_sql()
    assert set(sql) <= set(qs) <= set(entry.queries())
    assert set(qs) == set(sql)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["month", "asset_name", "metric_name"]
    assert df.count() == 231


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
