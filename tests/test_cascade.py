import datetime as dt

from pyspark.sql import functions as F

from tollgate.operators import cascade
from tollgate.spec import CascadeSpec, StepWindow

A = dt.datetime(2020, 1, 10, 12, 0)
SPEC = CascadeSpec(steps=(StepWindow("s", "s", 31, 60), StepWindow("t", "t", 0, 0)))


def track(spark, events, spec=SPEC, entities=None):
    ent = spark.createDataFrame(entities or [(1, A)], "entity_id long, anchor_ts timestamp")
    log = spark.createDataFrame(events, "entity_id long, step_type string, step_ts timestamp")
    return {r["entity_id"]: r for r in cascade.track(ent, log, spec).collect()}


def d(days, hours=0):
    return A + dt.timedelta(days=days, hours=hours)


def test_window_boundaries_days_mode(spark):
    for days, expect in ((30, False), (31, True), (60, True), (61, False), (-5, False)):
        r = track(spark, [(1, "s", d(days))], SPEC.with_(policy="earliest"))[1]
        assert r["s_in_window"] is expect, days
        assert r["s_days_after_anchor"] == days
    r = track(spark, [(1, "s", d(60, 11))])[1]          # 60 days 11 h -> still day 60
    assert r["s_in_window"] is True


def test_missing_step_is_not_null(spark):
    r = track(spark, [(1, "s", d(40))])[1]
    assert r["t_in_window"] is False and r["t_updated"] is False and r["t_days_after_anchor"] is None
    assert r["transition_failure"] is True
    assert r["days_to_complete_all"] == 40


def test_any_policy_finds_in_window_event_among_several(spark):
    ev = [(1, "s", d(5)), (1, "s", d(45)), (1, "s", d(90)), (1, "t", d(0, 3))]
    r = track(spark, ev)[1]
    assert r["s_in_window"] and r["s_days_after_anchor"] == 45 and r["t_in_window"]
    assert r["transition_failure"] is False
    r = track(spark, ev, SPEC.with_(policy="first"))[1]
    assert r["s_days_after_anchor"] == 5 and r["s_in_window"] is False


def test_anchor_day_edges_and_timestamp_mode(spark):
    ev = [(1, "t", A - dt.timedelta(hours=13))]  # 23:00 the day before -> floor -1
    r = track(spark, ev, SPEC.with_(policy="earliest"))[1]
    assert r["t_days_after_anchor"] == -1 and r["t_in_window"] is False
    ev = [(1, "t", A + dt.timedelta(hours=13))]  # 01:00 next day -> day 0 in days mode
    assert track(spark, ev)[1]["t_in_window"] is True
    assert track(spark, ev, SPEC.with_(mode="timestamp"))[1]["t_in_window"] is False
    assert track(spark, [(1, "t", A)], SPEC.with_(mode="timestamp"))[1]["t_in_window"] is True


def test_entities_without_anchor_or_events(spark):
    ents = [(1, A), (2, None), (3, A)]
    rows = track(spark, [(1, "s", d(40)), (2, "s", d(40)), (9, "s", d(40))], entities=ents)
    assert set(rows) == {1, 2, 3}
    assert rows[2]["s_updated"] is False and rows[3]["s_updated"] is False
    assert rows[3]["days_to_complete_all"] is None


def test_fixed_day_anchor_and_calendar_variant(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 2, 29),)], "dob timestamp")
    r = df.select(cascade.anchor_plus_days("dob").alias("a"),
                  cascade.anchor_plus_days("dob", calendar=True).alias("c")).first()
    assert r["a"] == dt.datetime(2000, 2, 29) + dt.timedelta(days=6570)
    assert r["c"] == dt.datetime(2018, 2, 28)


def test_window_from_days_only(spark):
    df = spark.createDataFrame([(5,), (30,), (31,), (999,), (None,)], "d long")
    got = [r[0] for r in df.select(cascade.window_from_days("d", hi=30)).collect()]
    assert got == [True, True, False, False, False]
    got = [r[0] for r in df.select(cascade.window_from_days("d", hi=30, lo=10)).collect()]
    assert got == [False, True, False, False, False]


def test_hot_entity_salting_gives_identical_results(spark):
    from conftest import SF_SMALL
    from tollgate.sources import bindings as B
    ent, log, spec = B.customers(spark, SF_SMALL)
    # one customer receives a third of all orders
    hot = log.withColumn("entity_id", F.when(F.col("entity_id") % 3 == 0, F.lit(1)).otherwise(F.col("entity_id")))
    plain = cascade.track(ent, hot, spec, skew_rows=None)
    salted = cascade.track(ent, hot, spec, skew_rows=50)
    cols = [c for c in plain.columns]
    assert sorted(map(tuple, plain.select(cols).collect())) == sorted(map(tuple, salted.select(cols).collect()))
    n_salts = cascade.hot_entities(cascade.step_events(hot, spec), "entity_id", 50).collect()
    assert len(n_salts) == 1 and n_salts[0]["__salts"] > 5
