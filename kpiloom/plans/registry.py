"""Registered queries (Spark) and their independent oracles (DuckDB SQL).

Every query reads the driver tables and derives its inputs with Spark, so its work grows with
them. Column names match the oracle exactly. The per-area modules in ``plans/checks`` register
themselves on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.plans.oracle import with_preamble

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Only the Pearson correlation is computed by a different algorithm in the two engines; it is
# compared at 9 decimals (the oracle rounds the same way). Every other double is compared as is.
DIGITS = 9


def rounded(df: DataFrame, *cols: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_preamble(oracle)
        return fn
    return deco


def _load() -> None:
    from kpiloom.plans.checks import (  # noqa: F401
        board, brief, events, health, medallion, normalize, peers, priority, quality, signals, silver, sources,
    )


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
