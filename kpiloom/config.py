"""Parameters of every operator, with defaults that reproduce the monitored pipeline.

All thresholds, lists and texts are parameters. The defaults below are fixed values: they must
equal the behaviour being reproduced, so they are stated plainly and kept together here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced pipeline; do not edit to make a test pass)
# ---------------------------------------------------------------------------------------------

# Header typo fixes applied after lower-casing and replacing " " and "." with "_".
INTERNAL_HEADER_RENAMES = {"%android": "pct_android", "otherl_traffic_plays": "other_traffic_plays"}

# Raw label columns replaced by canonical asset tags.
RAW_LABEL_COLUMNS = ("digital_active", "active_type")

# Default metric dictionary: (polarity, commercial weight) of every known metric.
METRIC_DICTIONARY = {
    "unique_visitors": (1, 0.65),
    "visits": (1, 0.55),
    "page_views": (1, 0.5),
    "international_visits": (1, 0.5),
    "mobile_visits": (1, 0.45),
    "search_organic_visits": (1, 0.55),
    "social_organic_visits": (1, 0.5),
    "marketing_visits": (1, 0.55),
    "other_channels_visits": (1, 0.4),
    "consumption": (1, 0.6),
    "bounce_rate": (-1, 0.55),
    "recurrence": (1, 0.6),
    "new_users": (1, 0.45),
    "logged_users": (1, 0.45),
    "purchases": (1, 0.85),
    "items": (1, 0.75),
    "net_sales": (1, 1.0),
    "search_organic_purchases": (1, 0.55),
    "social_organic_purchases": (1, 0.5),
    "marketing_purchases": (1, 0.6),
    "other_channels_purchases": (1, 0.45),
    "cart_value": (1, 0.75),
    "product_views_rate": (1, 0.5),
    "card_addition_rate": (1, 0.6),
    "checkout_rate": (1, 0.7),
    "conversion_rate": (1, 0.95),
    "daily_users": (1, 0.7),
    "video_plays": (1, 0.65),
    "streamers": (1, 0.6),
    "subscriptions": (1, 0.9),
    "search_organic_plays": (1, 0.45),
    "social_organic_plays": (1, 0.45),
    "marketing_plays": (1, 0.5),
    "other_traffic_plays": (1, 0.4),
    "subscription_rate": (1, 0.85),
    "streamers_rate": (1, 0.6),
    "video_recurrence": (1, 0.55),
    "video_play_rate": (1, 0.55),
    "video_progress_25_rate": (1, 0.5),
    "video_progress_50_rate": (1, 0.55),
    "video_progress_75_rate": (1, 0.6),
    "video_complete_rate": (1, 0.65),
    "app_downloads": (1, 0.5),
    "matchday_visits": (1, 0.6),
    "pct_android": (0, 0.2),
    "organic_launch_visits": (1, 0.45),
    "app_push_visits": (1, 0.5),
    "deeplink_visits": (1, 0.45),
    "other_channel_visits": (1, 0.35),
    "session_time_avg": (1, 0.55),
    "heavy_users": (1, 0.65),
    "user_rating": (1, 0.7),
    "total_engagement": (1, 0.7),
    "avg_engagement_per_post": (1, 0.8),
    "engagement_rate": (1, 0.9),
    "instagram_engagement": (1, 0.75),
    "total_posts": (0, 0.3),
    "international_engagement_ratio": (1, 0.6),
    "total_estimated_views": (1, 0.6),
}

# Measure allowlist of the internal sheets, in its original order (marketing_visits is listed twice).
INTERNAL_ALLOWLIST = (
    "unique_visitors", "visits", "page_views", "international_visits", "mobile_visits",
    "search_organic_visits", "social_organic_visits", "marketing_visits",
    "other_channels_visits", "consumption", "bounce_rate", "recurrence",
    "new_users", "logged_users", "purchases", "items", "net_sales",
    "search_organic_purchases", "social_organic_purchases", "marketing_purchases",
    "other_channels_purchases", "cart_value", "product_views_rate", "card_addition_rate",
    "checkout_rate", "conversion_rate", "daily_users", "video_plays", "streamers",
    "subscriptions", "search_organic_plays", "social_organic_plays", "marketing_plays",
    "other_traffic_plays", "subscription_rate", "streamers_rate", "video_recurrence",
    "video_play_rate", "video_progress_25_rate", "video_progress_50_rate",
    "video_progress_75_rate", "video_complete_rate", "app_downloads", "matchday_visits",
    "pct_android", "organic_launch_visits", "app_push_visits", "deeplink_visits",
    "marketing_visits", "other_channel_visits", "session_time_avg", "heavy_users", "user_rating",
)

# Measure allowlist of the benchmark sheets.
BENCHMARK_ALLOWLIST = (
    "unique_visitors", "visits", "bounce_rate", "recurrence",
    "conversion_rate", "cart_value", "daily_users", "streamers_rate",
    "video_play_rate", "app_downloads", "matchday_visits", "heavy_users", "user_rating",
)

# Measures of the optional social peer source.
SOCIAL_MEASURES = ("avg_engagement_per_post", "total_engagement", "instagram_engagement_rate",
                   "posting_frequency_per_day")

# Health status labels, trend labels and category labels.
STATUS_GOOD, STATUS_REVIEW, STATUS_STABLE = "good", "review", "stable"
TREND_UP, TREND_DOWN, TREND_FLAT = "up", "down", "flat"
CATEGORY_CONVERSION = "conversion weakness"
CATEGORY_GROWTH = "growth risk"
CATEGORY_BENCHMARK = "benchmark underperformance"
CATEGORY_ENGAGEMENT = "engagement opportunity"
CATEGORY_RESILIENCE = "resilience concern"

# Board texts.
WHY_SIGNALS = "This metric is connected to validated leading indicators and can affect commercial outcomes."
WHY_PEERS = "This metric has measurable peer benchmark context and a defined competitive gap."
WHY_DEFAULT = "This metric is persistently outside stable range and requires operational review."
NEXT_CONVERSION = "Investigate funnel drop-off points and recent checkout changes."
NEXT_GROWTH = "Review acquisition channels and campaign pacing for this asset."
NEXT_BENCHMARK = "Compare competitor tactics for this KPI and isolate the largest monthly delta driver."
NEXT_DEFAULT = "Review segment-level drivers and data quality checks before taking action."

# Default signal pairs: targets, then candidates with interpretation templates ("{}" = target).
SIGNAL_TARGETS = (
    ("ecommerce", "net_sales"),
    ("ecommerce", "conversion_rate"),
    ("streaming", "subscriptions"),
)
SIGNAL_CANDIDATES = (
    ("fan_app", "heavy_users",
     "Rising app engagement from heavy users predicts increased {} in the following months."),
    ("main_website", "bounce_rate",
     "Increased friction (bounce rate) on the main site tends to degrade {} over a lag window."),
    ("main_website", "unique_visitors",
     "Top-of-funnel traffic volume strongly leads {} shortly after."),
)

# Data-quality check names and details ({} is filled with the parameter shown).
DQ_DUPLICATE_NAME = "No duplicate keys on ({})"
DQ_DUPLICATE_DETAILS = "Duplicate key groups found for columns: {}"
DQ_CONDITION_DETAILS = "Failed condition: {}"
DQ_PEER_COVERAGE_NAME = "Exactly {} benchmark clubs per month+asset+metric"
DQ_PEER_COVERAGE_DETAILS = "Expected club_count == {} for each month, asset_name, metric_name."
DQ_MONTH_COVERAGE_NAME = "Complete monthly coverage by asset+metric"
DQ_MONTH_COVERAGE_DETAILS = "Expected each asset+metric to have month_count == {}."
DQ_RATE_NAME = "Rate metrics bounded between 0 and 1"
DQ_RATE_DETAILS = ("Found rate metric_value outside [0,1]. Note: recurrence metrics are excluded "
                   "as they are counts, not rates.")
DQ_RATE_PATTERN = "(_rate$|bounce_rate$)"

# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class HealthConfig:
    threshold: float = 0.05          # |polarity * deviation| strictly above -> good / review
    rolling_rows: int = 12           # rolling mean over the current and 11 preceding rows
    season_lag: int = 12             # "same month last season" lag
    min_season_history: int = 2      # seasonal z needs >= 2 earlier same-month rows
    default_polarity: int = 1
    calendar: bool = False           # True: lags/rolling by calendar month, not by row


@dataclass(frozen=True)
class PeerConfig:
    min_clubs: int = 5               # keep groups with at least this many distinct peer clubs
    change_lag: int = 12             # rank/gap change lookback in rows
    default_polarity: int = 1
    median_accuracy: int = 10000     # percentile_approx accuracy for the peer median
    bins_per_doubling: int = 64      # histogram bins of the rank: one for each 1.1 % of a value


@dataclass(frozen=True)
class SignalConfig:
    lags: tuple[int, ...] = (1, 2, 3)
    min_pairs: int = 12              # strictly more aligned months than this
    min_abs_corr: float = 0.65       # strictly above
    top_k: int = 3


@dataclass(frozen=True)
class CategoryRules:
    conversion_asset: str = "ecommerce"
    growth_patterns: tuple[str, ...] = ("%visitors%", "%app_downloads%")
    engagement_patterns: tuple[str, ...] = ("%recurrence%", "%heavy_users%")


@dataclass(frozen=True)
class PriorityConfig:
    persistence_rows: int = 3         # active rows among the current and 2 preceding rows
    evidence_full_count: int = 5      # supporting rows that give an evidence score of 1
    default_weight: float = 0.4
    validated_source_weight: float = 0.8
    categories: CategoryRules = field(default_factory=CategoryRules)
    # peer rank -> score; ranks at or above the first key score its value
    rank_scores: tuple[tuple[int, float], ...] = ((5, 1.0), (4, 0.8), (3, 0.4))
    # Evidence lists every other active metric of the same (month, asset): quadratic in that group.
    # Keys are unique and metrics come from a bounded allowlist; a larger group is an input error.


@dataclass(frozen=True)
class Weights:
    severity: float = 0.30
    persistence: float = 0.25
    peer_gap: float = 0.20
    commercial: float = 0.15
    evidence: float = 0.10

    def validate(self) -> "Weights":
        total = self.severity + self.persistence + self.peer_gap + self.commercial + self.evidence
        if abs(total - 1.0) > 1e-9:
            raise ValueError(f"score weights must sum to 1, got {total}")
        return self


@dataclass(frozen=True)
class BoardConfig:
    top_k: int = 10
    weights: Weights = field(default_factory=Weights)
    lookback_months: int = 3


@dataclass(frozen=True)
class BriefConfig:
    top_priorities: int = 3
    top_anomalies: int = 3
    top_signals: int = 3
    underperformance_rank: int = 4
    digits: int = 4
