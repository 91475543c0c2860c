import pytest

from tollgate.operators import metrics as M
from tollgate.operators import stats


def tracked_like(spark):
    rows = []
    for st, dist, n, k in (("A", "a1", 120, 60), ("A", "a2", 100, 90), ("B", "b1", 150, 30), ("B", "b2", 99, 99)):
        rows += [(st, dist, i < k, i % 2 == 0, float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "state string, district string, transition_failure boolean, "
                                       "urgent_in_window boolean, days_to_complete_all double")


def test_district_grid_and_pivot(spark):
    t = tracked_like(spark)
    g = {r["district"]: r for r in stats.district_risk_grid(t, min_size=100).collect()}
    assert set(g) == {"a1", "a2", "b1"}                     # b2 below the size floor
    assert g["a2"]["A"] == 0.9 and g["a2"]["B"] == 0.0     # filled with 0
    c = spark.createDataFrame([("x", "s1", 10.0), ("y", "s1", 20.0), ("x", "s2", 5.0)],
                              "cohort string, step string, completion_rate_pct double")
    p = {r["step"]: r for r in stats.cohort_pivot(c, ["x", "y"]).collect()}
    assert p["s1"]["x"] == 10.0 and p["s2"]["y"] is None
    assert stats.cohort_pivot(c, ["y"]).columns == ["step", "y"]


def test_effect_sizes_against_hand_values(spark):
    import math
    t = tracked_like(spark)
    r = {x["cohort_value"]: x for x in stats.cohort_effect_sizes(t, "state", "A").collect()}
    pa, pb = 150 / 220, 129 / 249
    assert r["B"]["risk_ratio"] == pytest.approx(pb / pa)
    assert r["B"]["cohens_h"] == pytest.approx(2 * math.asin(math.sqrt(pb)) - 2 * math.asin(math.sqrt(pa)))
    assert r["A"]["risk_difference"] == 0.0 and r["A"]["ci_low"] < pa < r["A"]["ci_high"]


def test_psi_and_calibration(spark):
    e = spark.createDataFrame([(0.05,), (0.15,), (0.15,), (0.95,)], "score double")
    a = spark.createDataFrame([(0.05,), (0.05,), (0.95,), (0.95,)], "score double")
    per = {r["bin"]: r for r in M.psi(e, a).collect()}
    assert per[1]["n_actual"] == 0 and per[1]["p_actual"] == pytest.approx(1e-4)
    total = sum(r["psi"] for r in per.values())
    assert total > 0
    cal = {r["bin"]: r for r in M.calibration_curve(spark.createDataFrame(
        [(1, 0.95), (0, 0.91), (1, 1.0)], "label int, score double")).collect()}
    assert set(cal) == {9} and cal[9]["n"] == 3 and cal[9]["observed_rate"] == pytest.approx(2 / 3)


def test_pivot_keeps_other_cohorts(spark):
    c = spark.createDataFrame([("x", "s1", 10, 1, 10.0), ("y", "s1", 20, 4, 20.0), ("z", "s1", 60, 36, 60.0), ("x", "s2", 10, 5, 50.0)],
                              "cohort string, step string, total long, completed long, completion_rate_pct double")
    p = {r["step"]: r.asDict() for r in stats.cohort_pivot(c, ["x"], other="rest").collect()}
    assert p["s1"] == {"step": "s1", "x": 10.0, "rest": 50.0, "rest_cohorts": 2}
    assert p["s2"] == {"step": "s2", "x": 50.0, "rest": None, "rest_cohorts": 0}
    p = {r["step"]: r.asDict() for r in stats.cohort_pivot(c, ["w"], other="rest").collect()}
    assert p["s1"]["w"] is None and p["s1"]["rest_cohorts"] == 3 and p["s1"]["rest"] == pytest.approx(4100 / 90)


def test_wide_risks_pad_with_null(spark):
    long = stats.high_risk_cohorts(tracked_like(spark).selectExpr("*", "'M' AS gender", "CAST(NULL AS STRING) AS urban_rural"))
    wide = stats.wide_risks(long).collect()
    assert len(wide) == long.count() and wide
    for r in wide:
        named = [c for c, _, _ in stats.HIGH_RISK_TYPES if r[c] is not None]
        assert named == [r["cohort_type"]] and (r["count"] >= 100 or r["cohort_type"] == "gender")


def test_gap_lines_name_large_gender_gaps_only(spark):
    from tollgate.spec import CascadeSpec, StepWindow
    spec = CascadeSpec(steps=(StepWindow("near", "n", 0, 10), StepWindow("wide", "w", 0, 10)), mode="days", policy="any")
    rows = [("M" if i % 2 else "F", "Urban" if i < 50 else "Rural", i % 2 == 1, i < 50, 1, 1) for i in range(100)]
    t = spark.createDataFrame(rows, "gender string, urban_rural string, wide_in_window boolean, near_in_window boolean, "
                                    "near_days_after_anchor int, wide_days_after_anchor int")
    gender, lag = (x.collect() for x in stats.gap_lines(t, spec))
    assert [(r["step"], r["divergence_pct_points"]) for r in gender] == [("wide", 100.0)]
    assert {r["step"]: r["completion_lag_pct_points"] for r in lag} == {"near": -100.0, "wide": 0.0}
