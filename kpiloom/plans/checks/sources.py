"""Source and sink checks: typed csv ingest with lineage, JSON dictionary, write round trip."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.health import with_polarity
from kpiloom.plans.fixtures import FIXTURE_DIM, W_IDS, W_MEASURES, Inputs
from kpiloom.plans.registry import register
from kpiloom.session import scratch_path
from kpiloom.sources.config_json import metric_dim_from_json
from kpiloom.sources.ingest import read_raw
from kpiloom.sources.sinks import write_table

WIDE_SCHEMA = "month date, club string, asset_name string, " + ", ".join(f"{m} double" for m in W_MEASURES)


@register("csv_ingest_lineage", """
select month, club, asset_name, order_count, net_sales, cart_value, active_customers, discount_rate, return_rate,
       units, 'csv' as source_format, true as has_load_time
from W
""")
def q_csv_ingest_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Land the wide sheet as csv files, then ingest them with an explicit schema and lineage."""
    landing = scratch_path(spark, "landing_csv")
    Inputs(spark, sf).wide().write.option("header", "true").csv(landing)
    raw = read_raw(spark, landing, "csv", WIDE_SCHEMA)
    return raw.select(*W_IDS, *W_MEASURES,
                      F.regexp_extract("source_file_name", r"\.([a-z]+)$", 1).alias("source_format"),
                      F.col("ingestion_timestamp").isNotNull().alias("has_load_time"))


def write_dictionary(spark: SparkSession, entries: dict) -> str:
    """Write a metric dictionary as one pretty-printed JSON document (multi-line) and return its folder."""
    text = json.dumps({k: {"polarity": p, "commercial_weight": w} for k, (p, w) in entries.items()}, indent=4)
    path = scratch_path(spark, "metric_dictionary")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


@register("metric_dim_lookup", """
, m as (select metric_name, count(*) as fact_rows from S group by metric_name)
select m.metric_name, coalesce(D.polarity, 1) as polarity, coalesce(D.commercial_weight, 0.4::double) as commercial_weight,
       m.fact_rows
from m left join D on m.metric_name = D.metric_name
""")
def q_metric_dim_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary read from JSON, applied to the metrics present in the subject fact."""
    dim = metric_dim_from_json(spark, write_dictionary(spark, FIXTURE_DIM))
    fact = Inputs(spark, sf).subject_fact()
    counts = fact.groupBy("metric_name").agg(F.count(F.lit(1)).alias("fact_rows"))
    out = with_polarity(counts, dim).join(dim.select("metric_name", "commercial_weight"),
                                         "metric_name", "left")
    return out.select("metric_name", F.col("polarity").cast("int").alias("polarity"),
                      F.coalesce("commercial_weight", F.lit(0.4)).alias("commercial_weight"), "fact_rows")


@register("fact_sink_roundtrip", """
select month, club, asset_name, metric_name, metric_value, (select count(*) from F) as written_rows from F
""")
def q_fact_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write the fact partitioned by month (row count observed during the write), read it back."""
    target = scratch_path(spark, "fact")
    n = write_table(Inputs(spark, sf).fact(), target, partition_by=("month",))
    back = spark.read.parquet(target)
    return back.select("month", "club", "asset_name", "metric_name", "metric_value",
                       F.lit(n).cast("long").alias("written_rows"))


REWRITTEN = "1995-03-01"


@register("fact_month_rewrite", f"""
select month, club, asset_name, metric_name, metric_value + case when month = date '{REWRITTEN}' then 1 else 0 end as metric_value,
       month <> date '{REWRITTEN}' as file_untouched, (select count(*) from F where month = date '{REWRITTEN}') as rewritten_rows,
       1 as files_of_month
from F
""")
def q_fact_month_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """One month of a partitioned fact rewritten; every other month keeps its file, and a month is one file."""
    target = scratch_path(spark, "fact_by_month")
    inp = Inputs(spark, sf, shared=True)
    write_table(inp.base_fact(), target, partition_by=("month",))
    files = lambda: spark.read.parquet(target).select("month", F.col("_metadata.file_path").alias("file")).distinct()
    before = files().checkpoint(eager=True)
    change = inp.base_fact().where(F.col("month") == REWRITTEN).withColumn("metric_value", F.col("metric_value") + 1)
    n = write_table(change, target, partition_by=("month",), only_given_partitions=True)
    per_month = files().groupBy("month").agg(F.count("*").cast("int").alias("files_of_month"))
    back = spark.read.parquet(target).withColumn("file", F.col("_metadata.file_path"))
    kept = before.select("file", F.lit(True).alias("old"))
    return back.join(kept, "file", "left").join(per_month, "month").select(
        "month", "club", "asset_name", "metric_name", "metric_value", F.coalesce("old", F.lit(False)).alias("file_untouched"),
        F.lit(n).cast("long").alias("rewritten_rows"), "files_of_month")


@register("fact_saved_table", """
select month, club, asset_name, metric_name, metric_value, (select count(*) from F) as written_rows from F
""")
def q_fact_saved_table(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as a catalog table, written and read by name."""
    path = scratch_path(spark, "fact_table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    n = write_table(Inputs(spark, sf).fact(), name, as_table=True, path=path)
    return spark.read.table(name).select("month", "club", "asset_name", "metric_name", "metric_value", F.lit(n).cast("long").alias("written_rows"))


@register("stream_ingest_lineage", """
select month, club, asset_name, order_count, net_sales, cart_value, active_customers, discount_rate, return_rate,
       units, 'csv' as source_format, true as has_load_time
from W
""")
def q_stream_ingest_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Land the wide sheet in two deliveries, ingest after each (availableNow, defaults), read back."""
    from kpiloom.streaming import ingest_available

    landing, target = scratch_path(spark, "landing_stream"), scratch_path(spark, "bronze_stream")
    wide, first = Inputs(spark, sf).wide().repartition("asset_name"), F.col("asset_name") < "c"
    for delivery in (wide.filter(first), wide.filter(~first)):
        delivery.write.mode("append").option("header", "true").csv(landing)
        ingest_available(spark, landing, WIDE_SCHEMA, target, "csv")
    back = spark.read.parquet(target)
    return back.select(*W_IDS, *W_MEASURES,
                       F.regexp_extract("source_file_name", r"\.([a-z]+)$", 1).alias("source_format"),
                       F.col("ingestion_timestamp").isNotNull().alias("has_load_time"))
