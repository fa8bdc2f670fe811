"""Column-expression helpers shared by the operators (all JVM-side, no UDFs)."""

from kpiloom.functions.expressions import (
    capped_ratio, first_match, guarded_relative_deviation, pearson, safe_z, signed_by_polarity, sized_broadcast,
    split_mean, step_score, title_case, trend,
)

__all__ = [
    "capped_ratio", "first_match", "guarded_relative_deviation", "pearson", "safe_z",
    "signed_by_polarity", "sized_broadcast", "split_mean", "step_score", "title_case", "trend",
]
