"""Property test: the one-pass quality aggregation equals a brute-force count on random facts."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kpiloom.operators.quality import quality_checks

FACT = "month date, asset_name string, metric_name string, metric_value double"
BFACT = "month date, asset_name string, metric_name string, metric_value double, club string"
MONTHS = [None] + [dt.date(1999 + i // 12, i % 12 + 1, 1) for i in range(30)]

row = st.tuples(st.sampled_from(MONTHS), st.sampled_from(["a", "b"]), st.sampled_from(["visits", "bounce_rate", "x_rate"]),
                st.one_of(st.none(), st.just(float("nan")), st.floats(-0.5, 1.5, allow_nan=False)))
brow = st.tuples(st.sampled_from(MONTHS[1:4]), st.sampled_from(["a"]), st.sampled_from(["visits"]),
                 st.floats(0, 9, allow_nan=False), st.sampled_from([f"c{i}" for i in range(6)]))


def brute(internal, bench, clubs=5):
    keys = {}
    for m, a, k, v in internal:
        keys.setdefault((m, a, k), []).append(v)
    series = {}
    for (m, a, k) in keys:
        series.setdefault((a, k), set()).add(m)
    all_months = {m for (m, _, _) in keys}
    total = len({m for m in all_months if m is not None}) + (1 if None in all_months else 0)
    rate_bad = sum(1 for m, a, k, v in internal if k.endswith("_rate") and v is not None
                   and (math.isnan(v) or v < 0 or v > 1))
    per_club, club_sets = {}, {}
    for m, a, k, v, c in bench:
        per_club[(m, a, k, c)] = per_club.get((m, a, k, c), 0) + 1
        club_sets.setdefault((m, a, k), set()).add(c)
    return {
        "No null months": sum(1 for r in internal if r[0] is None),
        "No null metric values": sum(1 for r in internal if r[3] is None),
        "No duplicate keys on (month, asset_name, metric_name)": sum(1 for v in keys.values() if len(v) > 1),
        "Complete monthly coverage by asset+metric":
            sum(1 for ms in series.values() if len({m for m in ms if m is not None}) != total),
        "Rate metrics bounded between 0 and 1": rate_bad,
        "No duplicate keys on (month, asset_name, metric_name, club)": sum(1 for n in per_club.values() if n > 1),
        "Exactly 5 benchmark clubs per month+asset+metric": sum(1 for s in club_sets.values() if len(s) != clubs),
    }


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=25), st.lists(brow, min_size=1, max_size=15))
def test_one_pass_checks_equal_brute_force(spark, internal, bench):
    res = quality_checks(spark.createDataFrame(internal, FACT), spark.createDataFrame(bench, BFACT), "p")
    got = {r.check_name: r.issue_count for r in res.collect()}
    assert got == brute(internal, bench)
