"""DataFrame -> DataFrame operators."""

from kpiloom.operators.board import priority_board, ranked_priorities
from kpiloom.operators.brief import brief_inputs
from kpiloom.operators.events import event_windows
from kpiloom.operators.health import kpi_health
from kpiloom.operators.normalize import clean_columns, normalize, normalize_sheets, unpivot_to_fact
from kpiloom.operators.peers import peer_benchmark, peer_stats
from kpiloom.operators.priority import priority_inputs
from kpiloom.operators.quality import QualityConfig, QualityGateError, quality_checks, quality_gate
from kpiloom.operators.signals import discover_signals, lag_correlations, metric_pivot

__all__ = [
    "QualityConfig", "QualityGateError", "brief_inputs", "clean_columns", "discover_signals", "event_windows",
    "kpi_health", "lag_correlations", "metric_pivot", "normalize", "normalize_sheets", "peer_benchmark",
    "peer_stats", "priority_board", "priority_inputs", "quality_checks", "quality_gate", "ranked_priorities",
    "unpivot_to_fact",
]
