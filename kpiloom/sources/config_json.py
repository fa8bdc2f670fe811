"""JSON configuration (SRC5) and tiny local relations (SRC6).

The metric dictionary maps a metric name to ``{polarity, commercial_weight}``. It is read by Spark
as one whole-text record and exploded into a small dimension. A malformed or empty file, or a
metric defined twice, is an error.
"""

from __future__ import annotations

from dataclasses import fields

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import METRIC_DICTIONARY, Weights

DIM_SCHEMA = "metric_name string, polarity int, commercial_weight double"
_DICT_TYPE = "map<string, struct<polarity: int, commercial_weight: double>>"
_WEIGHTS_TYPE = ("struct<formula_weights: struct<severity: double, persistence: double, "
                 "peer_gap: double, commercial: double, evidence: double>>")


def metric_dim_from_json(spark: SparkSession, path: str) -> DataFrame:
    """``{metric: {polarity, commercial_weight}}`` JSON file -> (metric_name, polarity, commercial_weight)."""
    raw = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", _DICT_TYPE, {"mode": "FAILFAST"})
    filled = F.when(F.size(parsed) > 0, parsed).otherwise(F.raise_error(F.lit("metric dictionary without entries")))
    entries = raw.select(F.explode(filled).alias("metric_name", "props"))
    # Several files may not define a metric twice: the joins on the dictionary would fan out.
    unique = entries.groupBy("metric_name").agg(F.count("*").alias("n"), F.first("props").alias("props"))
    props = F.when(F.col("n") == 1, F.col("props")).otherwise(F.raise_error(F.concat(F.lit("metric defined twice: "), "metric_name")))
    return unique.select("metric_name", props.alias("props")).select(
        "metric_name",
        F.col("props.polarity").alias("polarity"),
        F.col("props.commercial_weight").alias("commercial_weight"),
    )


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A tiny relation from local rows (SRC6), for parameter and configuration tables only.

    Rows go through Arrow into a ``LocalTableScan`` on the JVM: unlike ``createDataFrame`` on a
    Python list, no Python RDD is created, so the tasks that read it need no Python worker, and
    the optimizer knows its size.
    """
    names = [f.strip().split(" ", 1)[0] for f in schema.split(",")]
    pdf = pd.DataFrame.from_records(list(rows), columns=names).astype(object)
    pdf = pdf.where(pd.notna(pdf), None)
    return spark.createDataFrame(pdf, schema)


def metric_dim_from_dict(spark: SparkSession, entries: dict[str, tuple[int | None, float | None]]) -> DataFrame:
    """Small in-memory dimension from ``{metric: (polarity, commercial_weight)}``."""
    rows = [(k, None if p is None else int(p), None if w is None else float(w)) for k, (p, w) in entries.items()]
    return literal_rows(spark, rows, DIM_SCHEMA)


def default_metric_dim(spark: SparkSession) -> DataFrame:
    """The shipped dictionary: polarity and commercial weight of the known metrics."""
    return metric_dim_from_dict(spark, METRIC_DICTIONARY)


def weights_from_json(spark: SparkSession, path: str | None) -> Weights:
    """Scoring weights from ``{"formula_weights": {...}}``; defaults when no file is given.

    This collects one tiny record (five numbers) because the weights become literals in the plan.
    """
    if path is None:
        return Weights()
    raw = spark.read.text(path, wholetext=True)
    row = raw.select(F.from_json("value", _WEIGHTS_TYPE, {"mode": "FAILFAST"}).alias("c")).select("c.formula_weights.*").first()
    given = {} if row is None else row.asDict()
    if missing := sorted(f.name for f in fields(Weights) if given.get(f.name) is None):
        raise ValueError(f"scoring weights without {', '.join(missing)}")
    return Weights(**given).validate()
