"""Sinks (SNK1-3): overwrite a table, append a run log, and count rows while writing.

An overwrite can be limited to the partitions that are written; an append can be repeated safely. The row
count is taken with an ``Observation`` on the write itself, so the plan runs once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kpiloom.sources.tables import optional_source


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple[str, ...] = (), as_table: bool = False, path: str | None = None,
                only_given_partitions: bool = False) -> int:
    """Write ``df`` to a path, or to a catalog table (at ``path``, if given), and return the observed row count.

    With partition columns the rows are rebalanced on them first: a partition is one file, or several of
    the advisory size when it is large, instead of one file per task. ``only_given_partitions`` overwrites
    the partitions that ``df`` has rows of and leaves all others as they are (dynamic overwrite).
    """
    if only_given_partitions and (mode != "overwrite" or not partition_by):
        raise ValueError("only given partitions can be overwritten: needs mode overwrite and partition columns")
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    obs = Observation("write_count")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_given_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if as_table:
        writer.saveAsTable(target, **({"path": path} if path else {}))
    else:
        writer.save(target)
    return int(obs.get["rows"])


def append_log(df: DataFrame, target: str, fmt: str = "parquet", as_table: bool = False) -> int:
    """Append rows to a run log (columns must already be in the log's order)."""
    return write_table(df, target, fmt=fmt, mode="append", as_table=as_table)


def append_once(df: DataFrame, target: str, key: Sequence[str], fmt: str = "parquet", as_table: bool = False) -> int:
    """Append the rows whose key the log does not hold yet, so that a retry adds nothing twice; returns how many."""
    there = optional_source(df.sparkSession, target, fmt)
    if there is not None:
        df = df.join(there.select(*key), list(key), "left_anti").select(*df.columns)
    return append_log(df, target, fmt, as_table)
