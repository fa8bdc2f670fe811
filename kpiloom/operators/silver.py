"""Silver stage: many raw sheets reconciled to one declared contract (NRM, PRJ1-9, PRJ12, SET1, SRC7).

A contract names the columns of the long fact and their types. Every sheet is projected onto it by its
own schema: headers are cleaned and renamed, a missing column becomes a typed NULL, a column of another
type is cast, and text that cannot be cast is set aside. So sheets whose columns differ or drift union
without surprises, and nothing that is not understood gets lost or becomes a silent NULL: it is a row of
the rejects table, with the raw text and the reason.

All of it is narrow projections: no shuffle. Only what comes as text is looked through for rejects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampType

from kpiloom.config import BENCHMARK_ALLOWLIST, INTERNAL_ALLOWLIST, INTERNAL_HEADER_RENAMES
from kpiloom.operators.normalize import clean_columns, clean_header, metric_category, tag_asset

REJECT_SCHEMA = ("asset_name string, asset_type string, source_type string, source_file_name string, "
                 "ingestion_timestamp timestamp, month_text string, column_name string, raw_value string, reason string")
BAD_MONTH, BAD_NUMBER = "month cannot be read", "value is not a number"


@dataclass(frozen=True)
class SilverContract:
    """Identifying columns (name, type) of the fact, its measures, and how its headers and months are written."""

    ids: tuple[tuple[str, str], ...]
    measures: tuple[str, ...] | None                # None: every numeric column that is not an id
    source_type: str
    renames: Mapping[str, str] = field(default_factory=dict)
    with_category: bool = False
    month_formats: tuple[str, ...] = ()             # tried in order after ISO dates
    drop_nan: bool = True

    @property
    def id_names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.ids)

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.id_names, "metric_name", "metric_value", "source_type", *(("metric_category",) if self.with_category else ()))

    @property
    def schema(self) -> str:
        types = dict(self.ids) | {"metric_name": "string", "metric_value": "double", "source_type": "string", "metric_category": "string"}
        return ", ".join(f"{c} {types[c]}" for c in self.columns)


_TAIL = (("asset_name", "string"), ("asset_type", "string"), ("source_file_name", "string"), ("ingestion_timestamp", "timestamp"))
INTERNAL = SilverContract((("month", "date"), *_TAIL), INTERNAL_ALLOWLIST, "internal", INTERNAL_HEADER_RENAMES, with_category=True)
BENCHMARK = SilverContract((("month", "date"), ("club", "string"), *_TAIL), BENCHMARK_ALLOWLIST, "benchmark")


@dataclass(frozen=True)
class Sheet:
    """A raw table. Without a name it holds the rows of several assets, told apart by its ``asset_name`` column."""

    rows: DataFrame
    asset_name: str | None = None
    asset_type: str | None = None


def month_of(column: Column, kind, formats: Sequence[str]) -> Column:
    """The period as DATE: ISO first, then the formats in order; NULL if none fits."""
    if isinstance(kind, (DateType, TimestampType)):
        return column.cast("date")
    text = column.cast("string")
    return F.coalesce(F.try_to_date(text), *[F.try_to_date(text, f) for f in formats])


def number_of(column: Column, kind) -> tuple[Column, Column]:
    """(value as double, raw text if it is there but no number)."""
    if isinstance(kind, NumericType):
        return column.cast("double"), F.lit(None).cast("string")
    text = F.trim(column.cast("string"))
    value = text.try_cast("double")
    return value, F.when(value.isNull() & (text != ""), text)


def reconciled(sheet: Sheet, contract: SilverContract, rejected: bool = False) -> DataFrame:
    """The sheet in the contract's wide form: typed ids, ``month_text``, and its measures as doubles.

    ``rejected``: instead of the values, the text that is no number, of the measures that come as text.
    """
    raw = tag_asset(clean_columns(sheet.rows, contract.renames), sheet.asset_name, sheet.asset_type)
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    ids = []
    for name, kind in contract.ids:
        if name not in kinds:
            value = F.lit(None).cast(kind)
        elif name == "month":
            value = month_of(F.col(name), kinds[name], contract.month_formats)
        else:
            value = F.col(name).cast("string").try_cast(kind) if isinstance(kinds[name], StringType) else F.col(name).cast(kind)
        ids.append(value.alias(name))
    month_text = F.col("month").cast("string") if "month" in kinds else F.lit(None).cast("string")
    measures = [m for m in measures_of(raw, contract) if not (rejected and isinstance(kinds[m], NumericType))]
    cells = [number_of(F.col(f"`{m}`"), kinds[m])[int(rejected)].alias(m) for m in measures]
    return raw.select(*ids, month_text.alias("month_text"), *cells)


def measures_of(raw: DataFrame, contract: SilverContract) -> list[str]:
    """The contract's measures that the sheet has, in the sheet's order."""
    if contract.measures is None:
        return [f.name for f in raw.schema.fields if f.name not in contract.id_names and isinstance(f.dataType, NumericType)]
    allowed = set(contract.measures)
    return [c for c in raw.columns if c in allowed and c not in contract.id_names]


def wide_sheet(sheet: Sheet, contract: SilverContract) -> DataFrame:
    """The sheet's typed wide table: the contract's ids and the sheet's measures as doubles."""
    return reconciled(sheet, contract).drop("month_text")


def unreadable_month() -> Column:
    return F.col("month").isNull() & (F.trim("month_text") != "")


def cells(sheet: Sheet, contract: SilverContract, rejected: bool = False) -> DataFrame | None:
    """One row per cell: ids, month_text, metric_name and cell. None: the sheet has no such measure."""
    rows = reconciled(sheet, contract, rejected)
    ids = [*contract.id_names, "month_text"]
    measures = [c for c in rows.columns if c not in ids]
    return rows.unpivot(ids, measures, "metric_name", "cell") if measures else None


def silver_fact(sheets: Sequence[Sheet], contract: SilverContract) -> DataFrame:
    """All sheets in the contract's long form. Rows whose month cannot be read, and cells without a value, are left out."""
    found = [c for c in (cells(s, contract) for s in sheets) if c is not None]
    if not found:
        return sheets[0].rows.sparkSession.createDataFrame([], contract.schema)
    fact = reduce(DataFrame.unionByName, found).where(F.col("cell").isNotNull() & ~F.coalesce(unreadable_month(), F.lit(False)))
    if contract.drop_nan:
        fact = fact.where(~F.isnan("cell"))
    out = fact.select(*contract.id_names, "metric_name", F.col("cell").alias("metric_value"), F.lit(contract.source_type).alias("source_type"))
    if contract.with_category:
        out = out.withColumn("metric_category", metric_category(F.col("metric_name")))
    return out.select(*contract.columns)


def silver_rejects(sheets: Sequence[Sheet], contract: SilverContract) -> DataFrame:
    """What the fact leaves out: one row per sheet row with an unreadable month, and per cell that is no number.

    Sheets whose months and measures are typed cannot have any, and are not read for it.
    """
    lineage = lambda df: [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c)
                          for c, t in (("asset_name", "string"), ("asset_type", "string"), ("source_file_name", "string"), ("ingestion_timestamp", "timestamp"))]
    parts = []
    for sheet in sheets:
        rows = reconciled(sheet, contract)
        kinds = {clean_header(f.name, contract.renames): f.dataType for f in sheet.rows.schema.fields}
        if not isinstance(kinds.get("month"), (DateType, TimestampType)):
            parts.append(rows.where(unreadable_month()).select(
                *lineage(rows), "month_text", F.lit("month").alias("column_name"), F.col("month_text").alias("raw_value"), F.lit(BAD_MONTH).alias("reason")))
        each = cells(sheet, contract, rejected=True)
        if each is not None:
            parts.append(each.where(F.col("cell").isNotNull()).select(
                *lineage(each), "month_text", F.col("metric_name").alias("column_name"), F.col("cell").alias("raw_value"), F.lit(BAD_NUMBER).alias("reason")))
    if not parts:
        return sheets[0].rows.sparkSession.createDataFrame([], REJECT_SCHEMA)
    names = [c.split()[0] for c in REJECT_SCHEMA.split(", ")]
    typed = [p.withColumn("source_type", F.lit(contract.source_type)).select(*names) for p in parts]
    return reduce(DataFrame.unionByName, typed)


def normalize_internal(sheets: Sequence[Sheet], contract: SilverContract = INTERNAL) -> DataFrame:
    """NRM: the internal silver fact of all internal sheets."""
    return silver_fact(sheets, contract)


def normalize_benchmark(sheets: Sequence[Sheet], contract: SilverContract = BENCHMARK) -> DataFrame:
    """NRM: the benchmark silver fact of all benchmark sheets."""
    return silver_fact(sheets, contract)
