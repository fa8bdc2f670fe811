"""Silver checks: raw sheets with messy headers, missing columns and drifting types, reconciled to the two contracts.

Each market segment's monthly figures become one raw sheet, as a source might deliver it. The sheets differ:
one has text numbers with gaps, one writes months as text that is sometimes unreadable, one lacks columns,
one has no lineage. The subject's rows are the internal sheets, all others the benchmark sheets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.silver import BENCHMARK, INTERNAL, Sheet, normalize_benchmark, normalize_internal, silver_rejects
from kpiloom.plans.fixtures import SUBJECT, Inputs
from kpiloom.plans.registry import register

# Raw header of each derived measure, per kind of sheet; they clean to names of the allowlists.
INTERNAL_HEADERS = {"order_count": "Purchases", "net_sales": "Net.Sales", "cart_value": "CART_VALUE", "active_customers": "Unique Visitors",
                    "return_rate": "%Android", "discount_rate": "Bounce Rate", "units": "otherl_traffic_plays"}
BENCHMARK_HEADERS = {"order_count": "Visits", "cart_value": "Cart.Value", "active_customers": "Unique Visitors", "discount_rate": "BOUNCE_RATE",
                     "return_rate": "Conversion Rate"}
ASSETS = (("automobile", "main_website", "web"), ("building", "ecommerce", "web"), ("furniture", "streaming", "streaming"), ("household", "fan_app", "app"))
LOADED = "2024-01-01 00:00:00"


def raw_sheets(wide: DataFrame, headers: dict[str, str], with_club: bool) -> list[Sheet]:
    sheets = []
    for segment, asset, kind in ASSETS:
        rows = wide.where(F.col("asset_name") == segment)
        month, lineage = F.col("month"), [F.lit(f"{asset}.xlsx").alias("source_file_name"), F.to_timestamp(F.lit(LOADED)).alias("ingestion_timestamp")]
        cols = dict(headers)
        if asset == "ecommerce":        # months as text; those of one quarter cannot be read
            month = F.when(F.quarter("month") == 2, F.date_format("month", "'Q2/'yyyy")).otherwise(F.date_format("month", "yyyy-MM-dd"))
        if asset == "streaming":        # two measures are not delivered, and there is no lineage
            cols = {k: v for k, v in headers.items() if k not in ("cart_value", "active_customers")}
            lineage = []
        measures = [F.col(k).alias(v) for k, v in cols.items()]
        if asset == "fan_app":          # whole numbers as text, with a mark where the figure is missing; a measure as int
            text = F.concat(F.lit(" "), F.col("order_count").cast("long").cast("string"), F.lit(" "))
            marked = F.when(F.month("month") == 12, F.lit("n/a")).when(F.month("month") == 11, F.lit("")).otherwise(text)
            measures = [marked.alias(v) if k == "order_count" else F.col(k).cast("int").alias(v) if k == "active_customers" else F.col(k).alias(v)
                        for k, v in cols.items()]
        club = [F.col("club")] if with_club else []
        sheets.append(Sheet(rows.select(month.alias("Month"), *club, *measures, F.lit("wrong").alias("Digital Active"), F.lit("x").alias("active_type"),
                                        (F.col("order_count") * 2).alias("Legacy Score"), *lineage), asset, kind))
    return sheets


def internal_sheets(inp: Inputs) -> list[Sheet]:
    return raw_sheets(inp.wide().where(F.col("club") == inp.subject), INTERNAL_HEADERS, with_club=False)


def benchmark_sheets(inp: Inputs) -> list[Sheet]:
    return raw_sheets(inp.wide().where(F.col("club") != inp.subject), BENCHMARK_HEADERS, with_club=True)


def shared_wide(inp: Inputs) -> Inputs:
    """Every sheet is a branch over the wide table: it is derived once."""
    from kpiloom.session import checkpoint_root
    checkpoint_root(inp.spark)
    wide = inp.wide().checkpoint(eager=True)
    inp.wide = lambda club=None: wide if club is None else wide.where(F.col("club") == club)
    return inp


# Oracle: the cells of all sheets straight from the derived wide table.
SILVER_CTE = f"""
, assets as (select * from (values {", ".join(str(a) for a in ASSETS)}) t(segment, asset_name, asset_type)),
cells as (
  select month, club, a.asset_name, a.asset_type, metric, value
  from (unpivot W on order_count, net_sales, cart_value, active_customers, discount_rate, return_rate, units into name metric value value) w
  join assets a on w.asset_name = a.segment),
told as (
  select *, case when asset_name = 'streaming' then null else asset_name || '.xlsx' end as source_file_name,
         case when asset_name = 'streaming' then null else timestamp '{LOADED}' end as ingestion_timestamp,
         asset_name = 'ecommerce' and quarter(month) = 2 as bad_month,
         asset_name = 'streaming' and metric in ('cart_value', 'active_customers') as missing,
         asset_name = 'fan_app' and metric = 'order_count' and month(month) = 12 as bad_value,
         asset_name = 'fan_app' and metric = 'order_count' and month(month) = 11 as blank
  from cells)
"""
NAMES = """(values {}) n(metric, metric_name)"""
INTERNAL_NAMES = NAMES.format("('order_count', 'purchases'), ('net_sales', 'net_sales'), ('cart_value', 'cart_value'), ('active_customers', 'unique_visitors'), "
                              "('return_rate', 'pct_android'), ('discount_rate', 'bounce_rate'), ('units', 'other_traffic_plays')")
BENCHMARK_NAMES = NAMES.format("('order_count', 'visits'), ('cart_value', 'cart_value'), ('active_customers', 'unique_visitors'), "
                               "('discount_rate', 'bounce_rate'), ('return_rate', 'conversion_rate')")
KEPT = "not bad_month and not missing and not bad_value and not blank"


@register("normalize_internal", SILVER_CTE + f"""
select month, asset_name, asset_type, source_file_name, ingestion_timestamp, metric_name, value as metric_value, 'internal' as source_type,
       case when metric_name like '%rate%' then 'quality' else 'volume' end as metric_category
from told join {INTERNAL_NAMES} using (metric) where club = '{SUBJECT}' and {KEPT}
""")
def q_normalize_internal(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_internal(internal_sheets(shared_wide(Inputs(spark, sf))))


@register("normalize_benchmark", SILVER_CTE + f"""
select month, club, asset_name, asset_type, source_file_name, ingestion_timestamp, metric_name, value as metric_value, 'benchmark' as source_type
from told join {BENCHMARK_NAMES} using (metric) where club <> '{SUBJECT}' and {KEPT}
""")
def q_normalize_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_benchmark(benchmark_sheets(shared_wide(Inputs(spark, sf))))


@register("normalize_rejects", SILVER_CTE + f"""
, sides as (select 'internal' as source_type, '{SUBJECT}' as sole, null as other union all select 'benchmark', null, '{SUBJECT}'),
mine as (select t.*, source_type from told t join sides on (sole is null or club = sole) and (other is null or club <> other)),
names as (select 'internal' as source_type, * from {INTERNAL_NAMES} union all select 'benchmark', * from {BENCHMARK_NAMES})
select distinct source_type, asset_name, asset_type, source_file_name, ingestion_timestamp, 'Q2/' || cast(year(month) as varchar) as month_text,
       'month' as column_name, 'Q2/' || cast(year(month) as varchar) as raw_value, 'month cannot be read' as reason, count(*) over (
         partition by source_type, asset_name, year(month)) as times
from (select distinct source_type, club, month, asset_name, asset_type, source_file_name, ingestion_timestamp from mine where bad_month) b
union all
select source_type, asset_name, asset_type, source_file_name, ingestion_timestamp, cast(month as varchar), metric_name, 'n/a', 'value is not a number', count(*)
from mine join names using (source_type, metric) where bad_value group by all
""")
def q_normalize_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable months and numbers of both kinds of sheets, equal ones counted."""
    inp = shared_wide(Inputs(spark, sf))
    rejects = silver_rejects(internal_sheets(inp), INTERNAL).unionByName(silver_rejects(benchmark_sheets(inp), BENCHMARK))
    return rejects.groupBy(*rejects.columns).agg(F.count("*").alias("times"))
