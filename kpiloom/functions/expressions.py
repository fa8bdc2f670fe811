"""Reusable column expressions: rule ladders, guarded arithmetic, ANSI-safe statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.config import TREND_DOWN, TREND_FLAT, TREND_UP


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """CASE ladder: the first true condition wins, else ``default``."""
    expr = None
    for cond, value in rules:
        val = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


def guarded_relative_deviation(value: Column, base: Column) -> Column:
    """``(value - base) / base``; NULL when ``base`` is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(value - base, base)


def safe_z(value: Column, mean: Column, std: Column, count: Column, min_count: int) -> Column:
    """Z-score when at least ``min_count`` history rows and a positive spread, else 0.0."""
    ok = (count >= min_count) & (std > 0)
    return F.when(ok, (value - mean) / std).otherwise(F.lit(0.0))


def trend(value: Column, prior: Column) -> Column:
    """up / down against the prior value, flat otherwise (including a NULL prior)."""
    return first_match([(value > prior, TREND_UP), (value < prior, TREND_DOWN)], TREND_FLAT)


def signed_by_polarity(x: Column, polarity: Column) -> Column:
    """``x`` oriented so that positive is better: +x for polarity 1, -x for -1, NULL otherwise."""
    return F.when(polarity == 1, x).when(polarity == -1, -x)


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation as an aggregate; NULL (not an error) when either side has no spread.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for constant inputs; ``try_divide`` yields NULL.
    """
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    return F.try_divide(F.covar_pop(xc, yc), F.stddev_pop(xc) * F.stddev_pop(yc))


def capped_ratio(numerator: Column, full: float | int) -> Column:
    """``least(1.0, numerator / full)`` as a double."""
    return F.least(F.lit(1.0), numerator / F.lit(float(full)))


def step_score(x: Column, steps: Sequence[tuple[int, float]], default: float = 0.0) -> Column:
    """Step function: NULL -> default; ``x >= k`` for the first step k (descending), ``x == k`` below."""
    ordered = sorted(steps, key=lambda kv: -kv[0])
    rules: list[tuple[Column, object]] = [(x.isNull(), default)]
    for i, (k, score) in enumerate(ordered):
        rules.append(((x >= k) if i == 0 else (x == k), score))
    return first_match(rules, default)


def title_case(text: Column) -> Column:
    """Capitalise each space-separated word (``initcap``)."""
    return F.initcap(text)


DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def sized_broadcast(df, limit_bytes: int | None = None):
    """Broadcast ``df`` only if the optimizer's size estimate is at most ``limit_bytes``.

    Local parameter tables and dimensions have exact estimates. Above the limit (or when the
    estimate is unknown) the plain DataFrame is returned: the join stays a shuffle join, and AQE
    may still broadcast it if the size it measures at run time is small.
    """
    limit = DEFAULT_BROADCAST_LIMIT if limit_bytes is None else limit_bytes
    try:
        raw = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        size = raw if isinstance(raw, int) else int(raw.toString())   # py4j may already convert BigInt
    except Exception:  # noqa: BLE001 - no estimate: leave the choice to the planner
        return df
    return F.broadcast(df) if size <= limit else df


GRID = 1048576.0   # 2**20


def split_mean(x: Column, window=None) -> Column:
    """Mean as an aggregate that does not depend on summation order (in practice, bit for bit).

    Each value is split exactly into a part on a 2^-20 grid and a remainder below 2^-20
    (``a = x * 2^20``; ``fmod`` is exact). Sums of grid parts are exact in any order while the
    running sum stays below 2^33; the remainder sum is about 2^20 times smaller than the grid
    sum, so its order-dependent rounding essentially never changes the final double. Both sums
    are partial aggregates, like ``avg``. With ``window`` it is the same mean over a window frame.
    """
    a = x * F.lit(GRID)
    frac = a % F.lit(1.0)
    parts = [F.sum((a - frac) / F.lit(GRID)), F.sum(frac / F.lit(GRID)), F.count(x)]
    if window is not None:
        parts = [p.over(window) for p in parts]
    return (parts[0] + parts[1]) / parts[2]
