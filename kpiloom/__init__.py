"""kpiloom: Spark-native monitoring of business metrics over time and against peers.

Every operator is a ``DataFrame -> DataFrame`` function built from the DataFrame API, so
Catalyst plans it, AQE re-plans it at run time, and no Python runs per row.

Layers
------
sources/    typed reads, lineage columns, JSON config, sinks with observed row counts
functions/  column-expression helpers (classifier ladders, safe statistics, payloads)
operators/  normalise, health, peers, signals, priority, board, brief, quality, events
plans/      the derived wide monthly input and the end-to-end medallion run
streaming/  incremental file ingest into the bronze layer
"""

__version__ = "0.1.0"
