import datetime as dt

import pytest
from pyspark.sql import functions as F

import simulated_people as simulate
from tollgate.operators import cascade, features as FE, stats
from tollgate.spec import REFERENCE_SPEC


def test_simulated_cascade_shares_and_subset(spark):
    rows = spark.range(20000).select(F.col("id").cast("string").alias("entity_id"),
                                     F.lit(dt.datetime(2024, 6, 1)).alias("d"))
    people = simulate.individuals(rows, date_col="d")
    r = people.select(F.min(F.datediff(F.col("d"), F.col("dob"))).alias("lo"),
                      F.max(F.datediff(F.col("d"), F.col("dob"))).alias("hi")).first()
    assert (r["lo"], r["hi"]) == (6570, 6570 + 364)
    log = simulate.step_log(people)
    t = cascade.track(people.select("entity_id", "anchor_ts"), log, REFERENCE_SPEC)
    rates = {x["step"]: x["completion_rate_pct"] for x in stats.completion_rates(t, REFERENCE_SPEC).collect()}
    for step, share in (("biometric", 95), ("mobile", 75), ("address", 60), ("name", 40)):
        assert rates[step] == pytest.approx(share, abs=1.5)
    # shared draw: every mobile completer also completed biometric
    assert t.where("mobile_in_window AND NOT biometric_in_window").count() == 0
    fail = t.agg(F.avg(F.col("transition_failure").cast("double"))).first()[0]
    assert fail == pytest.approx(1 - 0.75 * 0.6 * 0.4, abs=0.015)


def test_window_and_missing_fallbacks_from_days(spark):
    from tollgate.spec import CascadeSpec, StepWindow
    spec = CascadeSpec(steps=(StepWindow("a", "a", 31, 60),))
    df = spark.createDataFrame([(1, 20), (2, 45), (3, None), (4, 70)], "entity_id long, a_days_after_anchor long")
    out = {r["entity_id"]: r for r in FE.base_features(df, spec).collect()}
    # C10 ignores the lower bound (20 counts as completed), NULL -> 999 -> missing
    assert [out[i]["a_window_completed"] for i in (1, 2, 3, 4)] == [1, 1, 0, 0]
    assert [out[i]["a_missing"] for i in (1, 2, 3, 4)] == [0, 0, 1, 0]
