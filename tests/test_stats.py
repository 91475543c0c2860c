import pytest
from pyspark.sql import functions as F

from tollgate.operators import stats
from tollgate.spec import REFERENCE_SPEC


def synthetic(spark, n, completed: dict, extra=None):
    """n rows with <step>_in_window true for the first completed[step] ids."""
    df = spark.range(n).withColumnRenamed("id", "entity_id")
    for s in REFERENCE_SPEC.step_names:
        df = df.withColumn(f"{s}_in_window", F.col("entity_id") < completed.get(s, 0))
        df = df.withColumn(f"{s}_days_after_anchor", F.lit(1).cast("long"))
    fail = F.lit(False)
    for s in REFERENCE_SPEC.step_names:
        fail = fail | ~F.col(f"{s}_in_window")
    df = df.withColumn("transition_failure", fail)
    return df if extra is None else extra(df)


def test_completion_rates_golden(spark):
    comp = {"biometric": 183314, "mobile": 144675, "address": 115785, "name": 77002}
    t = synthetic(spark, 192889, comp)
    got = {r["step"]: r for r in stats.completion_rates(t, REFERENCE_SPEC).collect()}
    assert got["biometric"]["completion_rate_pct"] == pytest.approx(95.0360051635915, rel=1e-12)
    assert got["mobile"]["completion_rate_pct"] == pytest.approx(75.00427707126896, rel=1e-12)
    assert got["address"]["completion_rate_pct"] == pytest.approx(60.02675113666409, rel=1e-12)
    assert got["name"]["completion_rate_pct"] == pytest.approx(39.92036870946503, rel=1e-12)
    for r in got.values():
        assert r["completed"] + r["missing"] == r["total_individuals"] == 192889
        assert r["window_days"] in ("0-0", "0-30", "31-60", "61-90")


def test_empty_table_rates_are_zero(spark):
    t = synthetic(spark, 0, {})
    rows = stats.completion_rates(t, REFERENCE_SPEC).collect()
    assert all(r["completion_rate_pct"] == 0.0 and r["total_individuals"] == 0 for r in rows)


def test_gender_divergence_golden(spark):
    # M: 91924 of 96754 biometric; F: 91390 of 96135 -> rates of the committed table
    def g(df):
        return df.withColumn("gender", F.when(F.col("entity_id") < 96754, "M").otherwise("F")).withColumn(
            "biometric_in_window", F.when(F.col("entity_id") < 96754, F.col("entity_id") < 91924)
            .otherwise(F.col("entity_id") < 96754 + 91390))
    t = synthetic(spark, 96754 + 96135, {}, g)
    r = [x for x in stats.binary_divergence(t, REFERENCE_SPEC).collect() if x["step"] == "biometric"][0]
    assert r["male_completion_rate_pct"] == pytest.approx(95.0079583273043, rel=1e-12)
    assert r["female_completion_rate_pct"] == pytest.approx(95.06423258958756, rel=1e-12)
    assert r["divergence_pct_points"] == pytest.approx(0.05627426228326726, rel=1e-9)
    assert r["relative_divergence"] == pytest.approx(-0.05627426228326726, rel=1e-9)


def test_one_gender_only_gives_zero_rate(spark):
    t = synthetic(spark, 10, {"biometric": 5}, lambda df: df.withColumn("gender", F.lit("M")))
    r = stats.binary_divergence(t, REFERENCE_SPEC).collect()[0]
    assert r["female_count"] == 0 and r["female_completion_rate_pct"] == 0.0


def test_area_lag_absent_area(spark):
    t = synthetic(spark, 10, {"mobile": 4}, lambda df: df.withColumn("urban_rural", F.lit("Rural")))
    r = {x["step"]: x for x in stats.area_lag(t, REFERENCE_SPEC).collect()}["mobile"]
    assert r["urban_completion_rate_pct"] == 0.0 and r["rural_completion_rate_pct"] == 40.0
    assert r["lag_days"] == 0.0 and r["urban_avg_days_to_update"] is None


def test_high_risk_min_size_topk_ties_and_nulls(spark):
    rows = []
    # state A: n=100 exactly, rate .5; B: n=99 (dropped); C, D tie at .8 (ordered by value)
    for st, n, k in (("A", 100, 50), ("B", 99, 99), ("C", 100, 80), ("D", 100, 80), (None, 100, 100)):
        rows += [(st, i < k, "M", "Urban", "x") for i in range(n)]
    t = spark.createDataFrame(rows, "state string, transition_failure boolean, gender string, "
                                    "urban_rural string, district string")
    types = (("state", 2, True), ("gender", None, False))
    got = stats.high_risk_cohorts(t, 100, types).collect()
    st = [(r["cohort_value"], r["rank_in_type"]) for r in got if r["cohort_type"] == "state"]
    assert st == [("C", 1), ("D", 2)] or sorted(st) == [("C", 1), ("D", 2)]
    assert [r["cohort_value"] for r in got if r["cohort_type"] == "gender"] == ["M"]


def test_chi_square_skips_empty_group(spark):
    t = spark.createDataFrame([("M", "Urban", True), ("M", "Urban", False)],
                              "gender string, urban_rural string, transition_failure boolean")
    assert stats.chi_square_tests(t).count() == 0


def test_cohort_totals_sum_to_global(spark):
    t = synthetic(spark, 1000, {"mobile": 300},
                  lambda df: df.withColumn("state", (F.col("entity_id") % 7).cast("string")))
    c = stats.cohort_completion_rates(t, REFERENCE_SPEC, "state").where("step = 'mobile'")
    s = c.agg(F.sum("total"), F.sum("completed")).first()
    assert tuple(s) == (1000, 300)
    assert stats.cohort_completion_rates(t, REFERENCE_SPEC, "absent").count() == 0
