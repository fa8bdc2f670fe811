"""JSON contracts of the board's evidence and the monthly brief (PRJ19, PRJ20): fields, order, kinds, columns.

FIXED VALUES: field names and their order. Writers, parsers and checks all read them from here.
"""

from __future__ import annotations

from kpiloom.functions.json_text import Many, Record, number, text, whole

SUPPORTING_ROW = Record({
    "metric_name": text("metric_name"), "metric_value": number("metric_value"), "health_status": text("health_status"),
    "trend_direction": text("trend_direction"), "deviation_from_rolling_avg": number("deviation_from_rolling_avg"),
    "seasonal_z_score": number("seasonal_z_score"), "severity_score": number("severity_score")})

SIGNAL_REFERENCE = Record({
    "signal_role": text("signal_role"), "source_asset": text("source_asset"), "source_metric": text("source_metric"),
    "target_asset": text("target_asset"), "target_metric": text("target_metric"), "lag_months": whole("lag_months"),
    "relationship_direction": text("relationship_direction"), "strength_score": number("strength_score"),
    "validation_status": text("validation_status"), "business_interpretation": text("business_interpretation")})

EVIDENCE = Record({
    "score_components": Record({
        "severity": number("severity_score"), "persistence": number("persistence_score"), "peer_gap": number("peer_gap_score"),
        "commercial_weight": number("commercial_weight_score"), "supporting_evidence": number("supporting_evidence_score")}),
    "severity_inputs": Record({
        "metric_value": number("metric_value"), "health_status": text("health_status"), "trend_direction": text("trend_direction"),
        "deviation_from_rolling_avg": number("deviation_from_rolling_avg"), "seasonal_z_score": number("seasonal_z_score")}),
    "persistence_inputs": Record({"active_months_in_last_3": whole("persistence_months"), "lookback_months": whole("lookback_months")}),
    "peer_context": Record({
        "peer_rank": whole("peer_rank"), "peer_club_count": whole("peer_club_count"), "peer_median": number("peer_median"),
        "peer_leader_value": number("peer_leader_value"), "gap_to_peer_median": number("gap_to_peer_median"),
        "gap_to_leader": number("gap_to_leader")}, source="peer_context"),
    "linked_signal_references": Many("linked_signal_refs", SIGNAL_REFERENCE),
    "supporting_metric_rows": Many("supporting_metric_rows", SUPPORTING_ROW)})

TOP_PRIORITY = Record({
    "priority_id": text("priority_id"), "priority_rank": whole("priority_rank"), "priority_title": text("priority_title"),
    "priority_category": text("priority_category"), "priority_score": number("priority_score")})

TOP_ANOMALY = Record({
    "anomaly_rank": whole("anomaly_rank"), "asset_name": text("asset_name"), "metric_name": text("metric_name"),
    "metric_value": number("metric_value"), "deviation_from_rolling_avg": number("deviation_from_rolling_avg")})

TOP_SIGNAL = Record({
    "signal_rank": whole("signal_rank"), "signal_id": text("signal_id"), "source_asset": text("source_asset"),
    "source_metric": text("source_metric"), "target_asset": text("target_asset"), "target_metric": text("target_metric"),
    "lag_months": whole("lag_months"), "relationship_direction": text("relationship_direction"), "strength_score": number("strength_score")})

BENCHMARK_SUMMARY = Record({
    "benchmarked_metric_count": whole("benchmarked_metric_count"),
    "benchmark_underperformance_count": whole("benchmark_underperformance_count"),
    "avg_gap_to_peer_median": number("avg_gap_to_peer_median"), "worst_gap_to_peer_median": number("worst_gap_to_peer_median")})

HEALTH_SUMMARY = Record({
    "metric_count": whole("metric_count"), "good_count": whole("good_count"), "review_count": whole("review_count"),
    "stable_count": whole("stable_count"), "avg_abs_deviation": number("avg_abs_deviation")})
