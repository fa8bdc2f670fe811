"""Raw dataset ingest (SRC1) and lineage columns (SRC2).

The monitored pipeline parses spreadsheets on the driver. Here every raw dataset is read by the
executors with an explicit schema (csv, json or parquet), and lineage comes from the file
metadata column, so nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | str | None = None,
             **options: str) -> DataFrame:
    """Read a raw dataset with an explicit schema; csv gets ``header=true`` unless overridden."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return add_lineage(reader.load(path))


def add_lineage(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Add ``source_file_name`` (file metadata) and ``ingestion_timestamp`` (load time)."""
    return df.withColumns({
        "source_file_name": F.col("_metadata.file_name"),
        "ingestion_timestamp": loaded_at if loaded_at is not None else F.current_timestamp(),
    })
