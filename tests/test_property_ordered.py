"""Property tests for the distributed ordered sums and quantiles."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tollgate.functions.ordered import exact_quantile, running_sums


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300), st.integers(1, 40),
       st.floats(0.0, 1.0))
def test_running_sums_and_quantile(spark, vals, buckets, q):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v long, w long")
    got = {(r["v"], r["w"]): r["cum_w"] for r in running_sums(df, ["v", "w"], ["w"], buckets=buckets).collect()}
    acc, exp = 0, {}
    for v, w in sorted((v, i) for i, v in enumerate(vals)):
        acc += w
        exp[(v, w)] = acc
    assert got == exp
    assert exact_quantile(df, "v", q, buckets=buckets) == pytest.approx(float(np.quantile(vals, q)), abs=1e-9)
