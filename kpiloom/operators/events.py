"""Event windows (EVT).

The monitored pipeline only names this step (load annotations, relative offsets, baseline and
deviation, write). Our definition: for each annotation (event_id, asset, event period) and each
offset in [-before, +after], the series value of that asset at period + offset; the baseline is
the mean over the negative offsets of the same event and metric; the deviation is relative to it.
Offsets without data are absent. The period unit is a day or a month.

Plan: annotations are multiplied by the fixed offset list (``explode(sequence)``, at most
before + after + 1 rows each) and equi-joined to the series on (asset, period); no range join.
The baseline is a window per (event, metric), which holds at most before + after + 1 rows; its
mean is an order-independent split sum, so it does not depend on row order within the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import guarded_relative_deviation, split_mean

WINDOW_COLUMNS = ("event_id", "asset_name", "metric_name", "event_period", "period_offset", "metric_value",
                  "baseline", "deviation")


def event_windows(series: DataFrame, annotations: DataFrame, before: int = 3, after: int = 3,
                  unit: str = "day", series_period: str = "day", event_period: str = "event_day") -> DataFrame:
    """series(period, asset_name, metric_name, metric_value) x annotations(event_id, asset_name, period)."""
    if unit not in ("day", "month"):
        raise ValueError("unit must be 'day' or 'month'")
    ann = annotations.select("event_id", "asset_name", F.col(event_period).alias("event_period"),
                             F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("period_offset"))
    shift = F.date_add if unit == "day" else F.add_months
    ann = ann.withColumn("period", shift(F.col("event_period"), F.col("period_offset")))
    ser = series.select(F.col(series_period).alias("period"), "asset_name", "metric_name", "metric_value")
    joined = ann.join(ser, ["asset_name", "period"])
    w = Window.partitionBy("event_id", "asset_name", "metric_name")
    base = split_mean(F.when(F.col("period_offset") < 0, F.col("metric_value")), w)
    out = joined.withColumn("baseline", base)
    out = out.withColumn("deviation", guarded_relative_deviation(F.col("metric_value"), F.col("baseline")))
    return out.select(*WINDOW_COLUMNS)
