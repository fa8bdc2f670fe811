"""Monitoring inputs derived from the driver tables.

Mapping: asset = customer market segment, club = customer nation, subject = one nation, peers =
the other nations, month = month of the order date. ``wide_monthly`` is the raw wide sheet
(one row per month x club x asset, one column per metric); ``normalize`` turns it into the fact.

Scale notes (``wide_monthly``):
* line items are pre-aggregated per order (map-side partial aggregation) before any join;
* orders are then rolled up per (customer, month) *before* the customer join, so a customer that
  holds a third of all orders arrives at that join as at most one row per month: no skewed
  partition, and ``count(distinct customer)`` becomes a plain count;
* the nation dimension is broadcast behind a size check (one row per nation); everything else
  is a shuffle join sized by AQE.
Money and quantities (2 decimals) are summed as whole cents, discounts (4 decimals) as basis
points, in ``long``: exact in any summation order, and cheaper than decimal sums (which need
``BigDecimal`` arithmetic once the sum precision passes 18 digits). The double of ``cents / 100``
equals the double of the exact decimal, so any engine gets the same measures. Inputs with more
decimals than that would be rounded half-up to the unit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.expressions import sized_broadcast
from kpiloom.operators.normalize import unpivot_to_fact
from kpiloom.sources.config_json import metric_dim_from_dict
from kpiloom.session import checkpoint_root
from kpiloom.sources.tables import read_table

SUBJECT = "NATION_0"
SUBJECT_REGION = "AFRICA"
W_IDS = ("month", "club", "asset_name")
W_MEASURES = ("order_count", "net_sales", "cart_value", "active_customers", "discount_rate",
              "return_rate", "units")
EXTRA_MEASURES = ("order_count", "net_sales", "cart_value")

# Metric dimension used with the derived data: (polarity, commercial_weight).
# active_customers is left out on purpose so that both defaults are exercised.
FIXTURE_DIM = {
    "order_count": (1, 0.55),
    "net_sales": (1, 1.0),
    "cart_value": (1, 0.75),
    "discount_rate": (-1, 0.55),
    "return_rate": (-1, 0.60),
    "units": (0, 0.30),
}


def scaled(col: str, decimals: int):
    """An amount with ``decimals`` decimals as an exact whole number of its smallest unit."""
    return F.round(F.col(col) * F.lit(10 ** decimals)).cast("long")


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Per-order line totals: quantity (centi-units), discount (basis points), returned lines, lines."""
    return lineitem.groupBy("l_orderkey").agg(
        F.sum(scaled("l_quantity", 2)).alias("q"),
        F.sum(scaled("l_discount", 4)).alias("d"),
        F.count_if(F.col("l_returnflag") == "R").alias("r"),
        F.count(F.lit(1)).alias("n"),
    )


def customer_months(orders: DataFrame, lineitem: DataFrame | None) -> DataFrame:
    """Orders (with their line totals when ``lineitem`` is given) rolled up per (customer, month)."""
    o = orders.select(
        "o_orderkey", "o_custkey",
        scaled("o_totalprice", 2).alias("price"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("month"),
    )
    aggs = [F.count(F.lit(1)).alias("orders"), F.sum("price").alias("price")]
    if lineitem is not None:
        lines = order_lines(lineitem)
        o = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
        aggs += [F.sum(c).alias(c) for c in ("q", "d", "r", "n")]
    return o.groupBy("o_custkey", "month").agg(*aggs)


def _measures(orders_col: str = "orders") -> dict:
    """Measure expressions over customer-month rows (lazy: only the requested ones are used)."""
    sales = F.sum("price").cast("double") / F.lit(100.0)
    lines = F.sum("n")
    return {
        "order_count": F.sum(orders_col).cast("double"),
        "net_sales": sales,
        "cart_value": sales / F.sum(orders_col),
        "active_customers": F.count(F.lit(1)).cast("double"),
        "discount_rate": (F.sum("d").cast("double") / F.lit(10000.0)) / lines,
        "return_rate": F.sum("r").cast("double") / lines,
        "units": F.sum("q").cast("double") / F.lit(100.0),
    }


def wide_monthly(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, nation: DataFrame, club: str | None = None) -> DataFrame:
    """W: one row per (month, club, asset_name) with seven metric columns.

    For one ``club`` only its customers' orders go into the aggregations: a semi-join thins them out first.
    """
    nat = nation.select(F.col("n_nationkey"), F.col("n_name").alias("club"))
    if club is not None:
        nat = nat.where(F.col("club") == club)
        customer = customer.join(sized_broadcast(nat), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
        orders = orders.join(customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    cm = customer_months(orders, lineitem)
    cust = customer.select(F.col("c_custkey"), F.col("c_nationkey"),
                           F.lower("c_mktsegment").alias("asset_name"))
    j = (cm.join(cust, cm.o_custkey == cust.c_custkey)
           .join(sized_broadcast(nat), F.col("c_nationkey") == F.col("n_nationkey")))
    m = _measures()
    return j.groupBy(*W_IDS).agg(*[m[k].alias(k) for k in W_MEASURES])


def wide_monthly_regions(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                         region: DataFrame) -> DataFrame:
    """Extra peer source: (month, club_name = region) with order_count, net_sales, cart_value."""
    cm = customer_months(orders, None)
    cust = customer.select("c_custkey", "c_nationkey")
    geo = (nation.select("n_nationkey", "n_regionkey")
           .join(region.select("r_regionkey", F.col("r_name").alias("club_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    j = (cm.join(cust, cm.o_custkey == cust.c_custkey)
           .join(sized_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    m = _measures()
    return j.groupBy("month", "club_name").agg(*[m[k].alias(k) for k in EXTRA_MEASURES])


class Inputs:
    """Lazily derived inputs for one data folder (each a DataFrame; nothing is collected)."""

    def __init__(self, spark: SparkSession, data_dir: str, subject: str = SUBJECT, shared: bool = False):
        self.spark = spark
        self.data_dir = data_dir
        self.subject = subject
        self.shared = shared              # several branches read the fact: materialise it once
        self._silver: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.data_dir, name)

    def wide(self, club: str | None = None) -> DataFrame:
        return wide_monthly(self.table("orders"), self.table("lineitem"), self.table("customer"),
                            self.table("nation"), club)

    def wide_regions(self) -> DataFrame:
        return wide_monthly_regions(self.table("orders"), self.table("customer"), self.table("nation"),
                                    self.table("region"))

    def fact(self, wide: DataFrame | None = None) -> DataFrame:
        """F: (month, club, asset_name, metric_name, metric_value), NULL measures dropped."""
        return unpivot_to_fact(self.wide() if wide is None else wide, W_IDS, W_MEASURES)

    def silver(self) -> DataFrame:
        """The fact, materialised once (eager checkpoint in the shared checkpoint folder).

        Subject and peer rows both come from it; without the materialisation each branch would
        re-derive the wide sheet from the order tables (the club filters differ, so the two
        branches are not identical subtrees and no exchange is reused). The checkpoint also cuts
        lineage: a lost executor never recomputes the order-table aggregation.
        """
        if self._silver is None:
            checkpoint_root(self.spark)
            self._silver = self.fact().checkpoint(eager=True)
        return self._silver

    def base_fact(self) -> DataFrame:
        """The materialised fact when several branches share it, else the lazy derivation."""
        return self.silver() if self.shared else self.fact()

    def subject_fact(self, fact: DataFrame | None = None) -> DataFrame:
        if fact is None:
            fact = self.silver() if self.shared else self.fact(self.wide(self.subject))
        return fact.filter(F.col("club") == self.subject).select("month", "asset_name", "metric_name",
                                                                 "metric_value")

    def peer_fact(self, fact: DataFrame | None = None) -> DataFrame:
        f = self.base_fact() if fact is None else fact
        return f.filter(F.col("club") != self.subject).select(
            "month", "asset_name", "metric_name", F.col("metric_value").alias("peer_value"), "club")

    def metric_dim(self) -> DataFrame:
        return metric_dim_from_dict(self.spark, FIXTURE_DIM)

    def daily_series(self) -> DataFrame:
        """E: daily value sums per event type."""
        ev = self.table("events")
        return ev.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("asset_name")).agg(
            (F.sum(scaled("value", 2)).cast("double") / F.lit(100.0)).alias("metric_value")
        ).withColumn("metric_name", F.lit("value_sum")).select("day", "asset_name", "metric_name",
                                                               "metric_value")

    def annotations(self, event_type: str = "purchase", min_value: float = 220.0) -> DataFrame:
        """A: events of one type from ``min_value`` on (a parameter, so the rule reads one row at a time)."""
        ev = self.table("events")
        return ev.filter((F.col("event_type") == event_type) & (F.col("value") >= min_value)).select(
            "event_id", F.to_date("ts").alias("event_day"), F.col("event_type").alias("asset_name"))
