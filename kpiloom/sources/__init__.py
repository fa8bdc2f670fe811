"""Sources and sinks: typed reads with lineage, JSON configuration, writes with observed counts."""

from kpiloom.sources.tables import TABLES, optional_source, read_table
from kpiloom.sources.ingest import add_lineage, read_raw
from kpiloom.sources.config_json import metric_dim_from_json, metric_dim_from_dict, weights_from_json
from kpiloom.sources.sinks import append_log, append_once, write_table

__all__ = [
    "TABLES", "read_table", "optional_source", "add_lineage", "read_raw", "metric_dim_from_json",
    "metric_dim_from_dict", "weights_from_json", "write_table", "append_log", "append_once",
]
