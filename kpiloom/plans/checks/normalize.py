"""Normalisation checks: header cleaning, pruning, unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.normalize import clean_columns, prune_measures, standardize_month, tag_asset, unpivot_to_fact
from kpiloom.plans.fixtures import W_IDS, W_MEASURES, Inputs
from kpiloom.plans.registry import register

RAW_HEADERS = {
    "order_count": "Order Count",
    "net_sales": "Net.Sales",
    "cart_value": "CART_VALUE",
    "return_rate": "%Android",
    "units": "otherl_traffic_plays",
    "active_customers": "Active Customers",
    "discount_rate": "discount_rate",
}
RAW_RENAMES = {"%android": "pct_android", "otherl_traffic_plays": "other_traffic_plays"}
CLEAN_ALLOWLIST = ("order_count", "net_sales", "cart_value", "active_customers", "discount_rate",
                   "pct_android", "other_traffic_plays")


def raw_sheet(inp: Inputs) -> DataFrame:
    """W with messy headers, a string month, raw label columns and one off-allowlist measure."""
    w = inp.wide()
    return w.select(
        F.date_format("month", "yyyy-MM-dd").alias("Month"), "club", "asset_name",
        *[F.col(k).alias(v) for k, v in RAW_HEADERS.items()],
        F.lit("web").alias("Digital Active"), F.lit("segment").alias("active_type"),
        (F.col("order_count") * 2).alias("Legacy Score"),
    )


@register("wide_normalize", """
select month, club, asset_name, 'segment' as asset_type, order_count, net_sales, cart_value,
       active_customers, discount_rate, return_rate as pct_android, units as other_traffic_plays
from W
""")
def q_wide_normalize(spark: SparkSession, sf: str) -> DataFrame:
    df = clean_columns(raw_sheet(Inputs(spark, sf)), RAW_RENAMES)
    df = standardize_month(df)
    df = tag_asset(df, asset_type="segment")
    return prune_measures(df, ("month", "club", "asset_name", "asset_type"), CLEAN_ALLOWLIST)


@register("fact_unpivot", """
select month, club, asset_name, metric_name, metric_value,
       case when metric_name like '%rate%' then 'quality' else 'volume' end as metric_category
from F
""")
def q_fact_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return unpivot_to_fact(Inputs(spark, sf).wide(), W_IDS, W_MEASURES, with_category=True)
