"""Property test: Spark tracking equals a brute-force Python cascade on random data."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tollgate.operators import cascade
from tollgate.spec import CascadeSpec, StepWindow

STEPS = (StepWindow("a", "a", 0, 0), StepWindow("b", "b", 2, 5), StepWindow("c", "c", 0, 10))
BASE = dt.datetime(2024, 1, 1)


def floor_days(later, earlier):
    return math.floor((later - earlier).total_seconds() / 86400)


def brute(anchor, events, spec):
    out = {}
    fail = False
    days_all = []
    for s in spec.steps:
        ts = sorted(t for k, t in events if k == s.value)

        def inw(t):
            if spec.mode == "timestamp":
                return anchor + dt.timedelta(days=s.lo) <= t <= anchor + dt.timedelta(days=s.hi)
            return s.lo <= floor_days(t, anchor) <= s.hi
        if anchor is None:
            chosen = None
        elif spec.policy == "earliest":
            chosen = ts[0] if ts else None
        else:
            after = [t for t in ts if t >= anchor]
            chosen = after[0] if after else None
            if spec.policy == "any":
                win = [t for t in ts if inw(t)]
                chosen = win[0] if win else chosen
        ok = chosen is not None and anchor is not None and inw(chosen)
        d = floor_days(chosen, anchor) if chosen is not None and anchor is not None else None
        out[s.name] = (chosen, d, ok)
        fail = fail or not ok
        if d is not None:
            days_all.append(d)
    return out, fail, (max(days_all) if days_all else None)


offsets = st.integers(min_value=-3 * 24 * 60, max_value=12 * 24 * 60)  # minutes around the anchor
entity = st.tuples(st.one_of(st.none(), st.integers(0, 24 * 60)),
                   st.lists(st.tuples(st.sampled_from(["a", "b", "c", "x"]), offsets), max_size=6))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(entity, min_size=1, max_size=25), st.sampled_from(["any", "first", "earliest"]),
       st.sampled_from(["days", "timestamp"]))
def test_track_equals_brute_force(spark, ents, policy, mode):
    spec = CascadeSpec(steps=STEPS, policy=policy, mode=mode)
    e_rows, l_rows, expect = [], [], {}
    for i, (amin, evs) in enumerate(ents):
        anchor = None if amin is None else BASE + dt.timedelta(minutes=amin)
        e_rows.append((i, anchor))
        events = [(k, (anchor or BASE) + dt.timedelta(minutes=m)) for k, m in evs]
        l_rows += [(i, k, t) for k, t in events]
        expect[i] = brute(anchor, events, spec)
    ent = spark.createDataFrame(e_rows, "entity_id long, anchor_ts timestamp")
    log = spark.createDataFrame(l_rows, "entity_id long, step_type string, step_ts timestamp")
    got = {r["entity_id"]: r for r in cascade.track(ent, log, spec, skew_rows=3).collect()}
    assert set(got) == set(expect)
    for i, (steps, fail, most) in expect.items():
        r = got[i]
        for name, (chosen, d, ok) in steps.items():
            assert r[f"{name}_update_ts"] == chosen, (i, name)
            assert r[f"{name}_days_after_anchor"] == d
            assert r[f"{name}_in_window"] is ok
        assert r["transition_failure"] is fail
        assert r["days_to_complete_all"] == most
