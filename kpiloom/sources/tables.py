"""Table scans (SRC3): one parquet dataset per table under a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.session import path_exists

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Scan ``<data_dir>/<name>.parquet``; a catalog table name is used when no folder is given."""
    if not data_dir:
        return spark.read.table(name)
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def optional_source(spark: SparkSession, name: str | None, fmt: str = "parquet") -> DataFrame | None:
    """An input that may be absent (SRC4): a table or view of the catalog, else a path; None if neither exists.

    Decided before anything is planned on it. Any other error (no permission, broken files) is raised.
    """
    if name is None:
        return None
    if "/" not in name:
        return spark.read.table(name) if spark.catalog.tableExists(name) else None
    return spark.read.format(fmt).load(name) if path_exists(spark, name) else None
