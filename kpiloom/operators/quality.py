"""Data-quality checks and gate (DQ1-7: PRD1-2, AGG8-10, CLS12, SNK2).

Each check yields one result row ``(run_id, table_name, check_name, severity, status,
issue_count, issue_details)``; PASS iff no issue. The results are one lazy DataFrame.

Plan: each fact is scanned and aggregated once, by its key, with partial aggregates, so a hot key is
pre-combined in every task; duplicates, coverage, months and row conditions follow from that level by
grouping sets. Any date is a month: months are counted as distinct values, with no range. The gate
collects the result rows (one per check) and logs a run once, however often it is retried.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.config import (
    DQ_CONDITION_DETAILS, DQ_DUPLICATE_DETAILS, DQ_DUPLICATE_NAME, DQ_MONTH_COVERAGE_DETAILS,
    DQ_MONTH_COVERAGE_NAME, DQ_PEER_COVERAGE_DETAILS, DQ_PEER_COVERAGE_NAME, DQ_RATE_DETAILS, DQ_RATE_NAME,
    DQ_RATE_PATTERN,
)
from kpiloom.sources.config_json import literal_rows
from kpiloom.sources.sinks import append_once

RESULT_COLUMNS = ("run_id", "table_name", "check_name", "severity", "status", "issue_count", "issue_details")
RESULT_SCHEMA = ("run_id string, table_name string, check_name string, severity string, status string, "
                 "issue_count bigint, issue_details string")
LOG_COLUMNS = RESULT_COLUMNS + ("run_timestamp",)
LOG_KEY = ("run_id", "table_name", "check_name")
REQUIRED = "REQUIRED"
DEFAULT_CONDITIONS = (("No null months", "month IS NOT NULL"),
                      ("No null metric values", "metric_value IS NOT NULL"))
SERIES = ("asset_name", "metric_name")
INTERNAL_KEYS = ("month", "asset_name", "metric_name")
BENCHMARK_KEYS = ("month", "asset_name", "metric_name", "club")


class QualityGateError(RuntimeError):
    """Raised when at least one REQUIRED check failed (after the results were logged)."""


@dataclass(frozen=True)
class QualityConfig:
    conditions: tuple[tuple[str, str], ...] = DEFAULT_CONDITIONS
    internal_keys: tuple[str, ...] = INTERNAL_KEYS
    benchmark_keys: tuple[str, ...] = BENCHMARK_KEYS
    expected_clubs: int = 5
    rate_pattern: str = DQ_RATE_PATTERN
    severity: str = REQUIRED                                # of every check that ``severities`` does not name
    benchmark_conditions: tuple[tuple[str, str], ...] = ()
    severities: tuple[tuple[str, str], ...] = ()            # (check name, severity); only REQUIRED ones block

    def severity_of(self, check: str) -> str:
        return dict(self.severities).get(check, self.severity)


def violated(condition: str) -> Column:
    """PRD1: a row violates ``condition`` unless it is true (NULL counts as a violation)."""
    return ~F.coalesce(F.expr(condition), F.lit(False))


def out_of_unit_range(value: Column) -> Column:
    """Outside [0, 1]; NaN counts as out of range."""
    return (value < 0) | (value > 1) | F.isnan(value)


def _rows(run_id: str, cfg: QualityConfig, specs: Sequence[tuple[str, str, Column, Column]]) -> Column:
    """Array of result structs from (table, check, issue_count, details) specs, for ``inline``."""
    return F.array(*[
        F.struct(F.lit(run_id).alias("run_id"), F.lit(t).alias("table_name"), F.lit(c).alias("check_name"),
                 F.lit(cfg.severity_of(c)).alias("severity"),
                 F.when(n == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                 n.cast("long").alias("issue_count"), d.alias("issue_details"))
        for t, c, n, d in specs])


def duplicates(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ3: one row, the number of keys that occur more than once."""
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("dupes"))


def internal_counts(fact: DataFrame, counts: Sequence[Column]) -> DataFrame:
    """DQ2, DQ3, DQ5 + AGG8-10 in one scan: one row with ``counts``, ``dupes``, ``months_total`` and ``incomplete``.

    The fact is aggregated once, by (series, month). Grouping sets over that level give the months of each
    series, the distinct months of all (NULL counts as one) and the totals. How many series have how many
    months is a short list (as long as there are different numbers of months).
    """
    names = [f"k{i}" for i in range(len(counts))]
    cells = fact.groupBy(*SERIES, "month").agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for c, k in zip(counts, names, strict=True)])
    cells = cells.withColumn("dated", F.when(F.col("month").isNotNull(), 1).otherwise(0))
    of_series, of_month, of_all = 1, 6, 7                   # a bit is set for each column that is not grouped
    level = cells.groupingSets([list(SERIES), ["month"], []], *SERIES, "month").agg(
        F.grouping_id().alias("gid"), F.sum("dated").alias("months"), F.count_if(F.col("n") > 1).alias("dupes"), *[F.sum(k).alias(k) for k in names])
    series = F.col("gid") == of_series
    total = lambda c: F.sum(F.when(F.col("gid") == of_all, F.col(c)))
    few = level.groupBy("gid", F.when(series, F.col("months")).alias("months")).agg(
        F.count(F.lit(1)).alias("groups"), *[F.sum(c).alias(c) for c in ("dupes", *names)])
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    one = few.agg(none(F.sum(F.when(F.col("gid") == of_month, F.col("groups")))).alias("months_total"),
                  F.collect_list(F.when(series, F.struct("months", "groups"))).alias("by_months"),
                  *[none(total(c)).alias(c) for c in ("dupes", *names)])
    other = F.filter("by_months", lambda x: x["months"] != F.col("months_total"))
    return one.withColumn("incomplete", F.aggregate(other, F.lit(0).cast("long"), lambda n, x: n + x["groups"])).drop("by_months")


def internal_checks(fact: DataFrame, table_name: str, run_id: str,
                    cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """DQ2, DQ3, DQ5, DQ6 over the internal fact: one scan, and one more if its keys are not (series, month)."""
    keys = list(cfg.internal_keys)
    rate_bad = F.col("metric_name").rlike(cfg.rate_pattern) & out_of_unit_range(F.col("metric_value"))
    conditions = [F.count_if(violated(expr)) for _, expr in cfg.conditions]
    row = internal_counts(fact, [F.count_if(rate_bad), *conditions])
    before, after = DQ_MONTH_COVERAGE_DETAILS.split("{}")
    specs = [(table_name, DQ_RATE_NAME, F.col("k0"), F.lit(DQ_RATE_DETAILS)),
             (table_name, DQ_MONTH_COVERAGE_NAME, F.col("incomplete"), F.concat(F.lit(before), F.col("months_total").cast("string"), F.lit(after))),
             *[(table_name, name, F.col(f"k{i + 1}"), F.lit(DQ_CONDITION_DETAILS.format(expr))) for i, (name, expr) in enumerate(cfg.conditions)]]
    duplicate = (table_name, DQ_DUPLICATE_NAME.format(", ".join(keys)), F.col("dupes"), F.lit(DQ_DUPLICATE_DETAILS.format(keys)))
    if set(keys) == {*SERIES, "month"}:
        return row.select(F.inline(_rows(run_id, cfg, [*specs, duplicate])))
    return row.select(F.inline(_rows(run_id, cfg, specs))).unionByName(duplicates(fact, keys).select(F.inline(_rows(run_id, cfg, [duplicate]))))


def benchmark_checks(fact: DataFrame, table_name: str, run_id: str,
                     cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """DQ2, DQ3 and DQ4 over the benchmark fact in one scan: by key and club, then by key, then all."""
    keys = list(cfg.benchmark_keys)
    group_keys = [k for k in keys if k != "club"]
    names = [f"k{i}" for i in range(len(cfg.benchmark_conditions))]
    sums = [F.sum(k).alias(k) for k in names]
    per_club = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(violated(expr)).alias(k) for k, (_, expr) in zip(names, cfg.benchmark_conditions, strict=True)])
    per_key = per_club.groupBy(*group_keys).agg(F.count("club").alias("clubs"), F.count_if(F.col("n") > 1).alias("dupes"), *sums)
    one = per_key.agg(F.coalesce(F.sum("dupes"), F.lit(0)).alias("dupes"), F.count_if(F.col("clubs") != cfg.expected_clubs).alias("bad"),
                      *[F.coalesce(s, F.lit(0)).alias(k) for s, k in zip(sums, names, strict=True)])
    return one.select(F.inline(_rows(run_id, cfg, [
        (table_name, DQ_DUPLICATE_NAME.format(", ".join(keys)), F.col("dupes"),
         F.lit(DQ_DUPLICATE_DETAILS.format(keys))),
        (table_name, DQ_PEER_COVERAGE_NAME.format(cfg.expected_clubs), F.col("bad"),
         F.lit(DQ_PEER_COVERAGE_DETAILS.format(cfg.expected_clubs))),
        *[(table_name, name, F.col(k), F.lit(DQ_CONDITION_DETAILS.format(expr))) for k, (name, expr) in zip(names, cfg.benchmark_conditions, strict=True)],
    ])))


def quality_checks(internal: DataFrame, benchmark: DataFrame, run_id: str,
                   internal_name: str = "silver_internal_asset_metrics",
                   benchmark_name: str = "silver_benchmark_asset_metrics",
                   cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """All checks as one DataFrame of result rows (lazy)."""
    i = internal_checks(internal, internal_name, run_id, cfg)
    b = benchmark_checks(benchmark, benchmark_name, run_id, cfg)
    return i.unionByName(b).select(*RESULT_COLUMNS)


def quality_gate(results: DataFrame, log_path: str | None = None, log_format: str = "parquet") -> DataFrame:
    """DQ7: append the results to the run log (if given), then raise if a REQUIRED check failed.

    The checks run once: their result (one row per check, a bound set by the configuration) is
    collected, logged, and then gated. The log is written before the gate raises, and holds each check
    of a run once: a retry with the same run id adds only what is missing.
    """
    spark = results.sparkSession
    rows = results.select(*RESULT_COLUMNS).collect()
    local = literal_rows(spark, [tuple(r) for r in rows], RESULT_SCHEMA)
    if log_path is not None:
        append_once(local.withColumn("run_timestamp", F.current_timestamp()).select(*LOG_COLUMNS), log_path,
                    LOG_KEY, fmt=log_format)
    failures = [r for r in rows if r.severity == REQUIRED and r.issue_count > 0]
    if failures:
        lines = [f"{r.table_name} :: {r.check_name} :: {r.issue_count} issues" for r in failures]
        raise QualityGateError(f"{len(lines)} required quality check(s) failed:\n- " + "\n- ".join(lines))
    return local
