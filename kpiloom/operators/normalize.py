"""Wide metric tables -> long fact (NRM: PRJ1-9, SET1, SRC7).

A raw table has one row per period (or period x club) and one column per metric. Normalising
cleans the headers, standardises the period, tags the asset, prunes measures to an allowlist and
unpivots to ``(ids..., metric_name, metric_value)``. Everything is a narrow projection: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from kpiloom.config import RAW_LABEL_COLUMNS

FACT_DIMS = ("month", "asset_name", "asset_type", "source_file_name", "ingestion_timestamp")


def clean_header(name: str, renames: Mapping[str, str] | None = None) -> str:
    """lower-case, ``' '`` and ``'.'`` -> ``'_'``, then an optional typo map."""
    new = name.lower().replace(" ", "_").replace(".", "_")
    return (renames or {}).get(new, new)


def clean_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename every column with :func:`clean_header` in one projection; reject collisions."""
    names = [clean_header(c, renames) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"cleaned headers collide: {dupes}")
    return df.toDF(*names)


def standardize_month(df: DataFrame, column: str = "month", lenient: bool = False) -> DataFrame:
    """Cast the period column to DATE. ``lenient`` turns unparseable strings into NULL."""
    fn = F.try_to_date if lenient else F.to_date
    return df.withColumn(column, fn(F.col(column)))


def tag_asset(df: DataFrame, asset_name: str | None = None, asset_type: str | None = None,
              drop: Iterable[str] = RAW_LABEL_COLUMNS) -> DataFrame:
    """Overwrite canonical asset tags with constants and drop the raw label columns."""
    tags: dict[str, Column] = {}
    if asset_name is not None:
        tags["asset_name"] = F.lit(asset_name)
    if asset_type is not None:
        tags["asset_type"] = F.lit(asset_type)
    out = df.withColumns(tags) if tags else df
    return out.drop(*drop)


def measure_columns(df: DataFrame, ids: Sequence[str], allowlist: Iterable[str] | None) -> list[str]:
    """Non-id columns on the allowlist; without an allowlist, every numeric non-id column."""
    if allowlist is None:
        return [f.name for f in df.schema.fields
                if f.name not in ids and isinstance(f.dataType, NumericType)]
    allowed = set(allowlist)
    return [c for c in df.columns if c not in ids and c in allowed]


def prune_measures(df: DataFrame, ids: Sequence[str], allowlist: Iterable[str] | None) -> DataFrame:
    """Keep the id columns and the allowlisted measures only (PRJ5)."""
    keep = [c for c in ids if c in df.columns] + measure_columns(df, ids, allowlist)
    return df.select(*keep)


def metric_category(metric: Column) -> Column:
    """``quality`` when the metric name contains ``rate``, else ``volume`` (PRJ8)."""
    return F.when(metric.like("%rate%"), F.lit("quality")).otherwise(F.lit("volume"))


def unpivot_to_fact(df: DataFrame, ids: Sequence[str], allowlist: Iterable[str] | None = None,
                    source_type: str | None = None, with_category: bool = False,
                    drop_nan: bool = True) -> DataFrame:
    """Wide -> long (PRJ6, PRJ8, PRJ9).

    Each measure is cast to double first, so mixed integer/double sheets unpivot cleanly. NULL
    measures are dropped; NaN too unless ``drop_nan`` is False. With no allowlisted measure the
    result is a typed empty fact (SRC7).
    """
    present_ids = [c for c in ids if c in df.columns]
    measures = measure_columns(df, ids, allowlist)
    if not measures:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields
                           if f.name in present_ids)
        schema += (", " if schema else "") + "metric_name string, metric_value double"
        empty = df.sparkSession.createDataFrame([], schema)
        extra: dict[str, Column] = {}
        if source_type is not None:
            extra["source_type"] = F.lit(source_type)
        if with_category:
            extra["metric_category"] = F.lit(None).cast("string")
        return empty.withColumns(extra) if extra else empty
    typed = df.select(*present_ids, *[F.col(f"`{m}`").cast("double").alias(m) for m in measures])
    fact = typed.unpivot(present_ids, measures, "metric_name", "metric_value")
    keep = F.col("metric_value").isNotNull()
    if drop_nan:
        keep = keep & ~F.isnan("metric_value")
    fact = fact.filter(keep)
    extra = {}
    if source_type is not None:
        extra["source_type"] = F.lit(source_type)
    if with_category:
        extra["metric_category"] = metric_category(F.col("metric_name"))
    return fact.withColumns(extra) if extra else fact


def normalize(wide: DataFrame, ids: Sequence[str] = FACT_DIMS, allowlist: Iterable[str] | None = None,
              renames: Mapping[str, str] | None = None, asset_name: str | None = None,
              asset_type: str | None = None, source_type: str | None = None,
              with_category: bool = False, month_column: str | None = "month",
              lenient_month: bool = False) -> DataFrame:
    """NRM: clean headers, standardise the month, tag the asset, prune, unpivot, drop NULLs."""
    df = clean_columns(wide, renames)
    if month_column is not None and month_column in df.columns:
        df = standardize_month(df, month_column, lenient_month)
    df = tag_asset(df, asset_name, asset_type)
    return unpivot_to_fact(df, ids, allowlist, source_type, with_category)


def normalize_sheets(sheets: Sequence[tuple[DataFrame, str, str]], **kwargs) -> DataFrame:
    """Normalise one raw table per asset ``(df, asset_name, asset_type)`` and union them by name (SET1)."""
    facts = [normalize(df, asset_name=name, asset_type=kind, **kwargs) for df, name, kind in sheets]
    return reduce(lambda a, b: a.unionByName(b), facts)
