import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.operators import stats


def poisson(u):
    """Smallest k with u < P(at most k), term by term."""
    k, term, total = 0, math.exp(-1), math.exp(-1)
    while u >= total:
        k, term = k + 1, term / (k + 1)
        total += term
    return k


def test_equals_plain_bootstrap_on_the_same_draws(spark):
    rng = np.random.default_rng(5)
    rows = [(i, ["x", "x", "x", "y", None][i % 5], None if i == 7 else int(rng.random() < 0.4)) for i in range(150)]
    df = spark.createDataFrame(rows, "entity_id long, c string, transition_failure int").withColumn("y", F.lit("clash"))
    got = {r["cohort_value"]: r for r in stats.bootstrap_intervals(df, "c", "y", replicates=40).collect()}
    assert set(got) == {"x", "y"}
    rates = {c: [] for c in got}
    for r in range(40):
        for c in rates:
            w = [(poisson(int(hashlib.md5(f"42:{i}:{r // 4}".encode()).hexdigest()[8 * (r % 4):][:8], 16) / 2**32), y)
                 for i, c2, y in rows if c2 == c and y is not None]
            rates[c].append(sum(k * y for k, y in w) / sum(k for k, _ in w))
    for c, rate in rates.items():
        kept = [y for _, c2, y in rows if c2 == c and y is not None]
        diff = np.array(rate) - np.array(rates["y"])
        want = [len(kept), sum(kept) / len(kept), *np.percentile(rate, [2.5, 97.5]), *np.percentile(diff, [2.5, 97.5])]
        assert np.allclose([got[c][k] for k in ("n", "failure_rate", "rate_low", "rate_high", "difference_low", "difference_high")], want)
    assert got["y"]["difference_low"] == got["y"]["difference_high"] == 0


def test_intervals_cover_the_true_rate(spark):
    rng = np.random.default_rng(8)
    rows = [(c * 1000 + i, f"c{c}", int(rng.random() < 0.3)) for c in range(100) for i in range(200)]
    df = spark.createDataFrame(rows, "entity_id long, c string, transition_failure int")
    got = stats.bootstrap_intervals(df, "c", "c0", replicates=200).collect()
    inside = sum(r["rate_low"] <= 0.3 <= r["rate_high"] for r in got)
    assert len(got) == 100 and 88 <= inside <= 100  # 95 expected, 2.2 standard deviation


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "entity_id long, c string, transition_failure int")
    assert stats.bootstrap_intervals(empty, "c", "x").count() == 0
    one = spark.createDataFrame([(1, "x", 1)], "entity_id long, c string, transition_failure int")
    r = stats.bootstrap_intervals(one, "c", "absent").first()  # replicates without the row say nothing
    assert (r["n"], r["rate_low"], r["rate_high"], r["difference_low"]) == (1, 1.0, 1.0, None)
    with pytest.raises(ValueError, match="fours"):
        stats.bootstrap_intervals(one, "c", "x", replicates=6)
    assert stats.poisson_cdf()[0] == math.exp(-1) and len(stats.poisson_cdf()) < 16
