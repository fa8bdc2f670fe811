"""Independent SQL (DuckDB dialect) for the derived inputs, shared as CTEs by the oracles.

This text is written separately from the Spark code: it uses exact decimal sums, DuckDB's
UNPIVOT, and joins orders to line items directly.
"""

from __future__ import annotations

from kpiloom.functions.json_text import Record

PREAMBLE = """
with li as (
  select l_orderkey, sum(cast(l_quantity as decimal(18,2))) q, sum(cast(l_discount as decimal(18,4))) d,
         sum(case when l_returnflag = 'R' then 1 else 0 end) r, count(*) n
  from lineitem group by l_orderkey),
W as (
  select cast(date_trunc('month', o_orderdate) as date) as month, n_name as club,
         lower(c_mktsegment) as asset_name,
         cast(count(*) as double) as order_count,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as net_sales,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as cart_value,
         cast(count(distinct o_custkey) as double) as active_customers,
         cast(sum(d) as double) / sum(n) as discount_rate,
         cast(sum(r) as double) / sum(n) as return_rate,
         cast(sum(q) as double) as units
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  left join li on l_orderkey = o_orderkey
  group by 1, 2, 3),
F as (
  select * from (unpivot W on order_count, net_sales, cart_value, active_customers, discount_rate,
                 return_rate, units into name metric_name value metric_value)),
S as (select month, asset_name, metric_name, metric_value from F where club = 'NATION_0'),
P as (select month, asset_name, metric_name, metric_value as peer_value, club from F where club <> 'NATION_0'),
D as (
  select metric_name, polarity, cast(commercial_weight as double) as commercial_weight from (values ('order_count', 1, 0.55), ('net_sales', 1, 1.0), ('cart_value', 1, 0.75),
                        ('discount_rate', -1, 0.55), ('return_rate', -1, 0.60), ('units', 0, 0.30))
         t(metric_name, polarity, commercial_weight)),
E as (
  select cast(ts as date) as day, event_type as asset_name, 'value_sum' as metric_name,
         cast(sum(cast(value as decimal(18,2))) as double) as metric_value
  from events group by 1, 2),
A as (
  select event_id, cast(ts as date) as event_day, event_type as asset_name from events
  where event_type = 'purchase' and value >= 220.0)
"""


def with_preamble(body: str) -> str:
    """Prefix ``body`` (which may start with ``, name as (...)`` CTEs or a select) with the preamble."""
    body = body.strip()
    if body.startswith(","):
        return PREAMBLE + body
    return PREAMBLE + "\n" + body


def record_sql(record: Record, columns: str = "{}", **parts: str) -> str:
    """DuckDB text expression of a JSON record. ``columns`` says how a column is written; ``parts`` are ready texts by field."""
    members = []
    for name, p in record.fields.items():
        if name in parts:
            value = parts[name]
        elif isinstance(p, Record):
            value = record_sql(p, columns)
        else:
            value = _VALUE_SQL[p.kind].format(x=columns.format(p.source))
        members.append(f"""'"{name}":' || ({value})""")
    return "'{' || array_to_string(list_filter([" + ", ".join(members) + "], lambda m: m is not null), ',') || '}'"


def list_sql(item: str, order: str) -> str:
    """Aggregate: the items in order, as a JSON list."""
    return f"'[' || coalesce(string_agg({item}, ',' order by {order}), '') || ']'"


_VALUE_SQL = {
    "text": "cast(to_json({x}) as varchar)",
    "whole": "cast(cast({x} as bigint) as varchar)",
    "number": "case when isfinite(cast({x} as double)) then regexp_replace(cast(cast(format('{{:.11e}}', cast({x} as double)) "
              "as decimal(38,18)) as varchar), '\\.?0+$', '') end",
}
