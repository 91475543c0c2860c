import pytest
from pyspark.sql import functions as F

from tollgate.operators import features as FE
from tollgate.operators import splits
from tollgate.spec import CascadeSpec, StepWindow


def labelled(spark, n=1000, pos_every=3):
    return spark.range(n).select(F.col("id").alias("entity_id"),
                                 (F.col("id") % pos_every == 0).alias("y"))


def test_split_is_exact_stratified_partition(spark):
    df = labelled(spark)
    s = splits.stratified_split(df, "entity_id", "y", seed=42)
    assert s.count() == 1000 and s.select("entity_id").distinct().count() == 1000
    c = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c[(True, "test")] == 67 and c[(True, "train")] == 267     # ceil(20% of 334)
    assert c[(False, "test")] == 134 and c[(False, "train")] == 532  # ceil(20% of 666)


def test_folds_balanced_and_shuffle_is_permutation(spark):
    df = labelled(spark)
    f = splits.stratified_folds(df, "entity_id", "y", k=5)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 2
    sh = splits.shuffled_labels(df, "entity_id", "y")
    assert sh.count() == 1000
    assert sh.where("shuffled_label").count() == df.where("y").count()
    assert sh.where("shuffled_label <> y").count() > 0


SPEC = CascadeSpec(steps=(StepWindow("a", "a", 0, 10), StepWindow("b", "b", 11, 20)))


def tracked(spark, rows):
    schema = ("entity_id long, anchor_ts timestamp, state string, gender string, y boolean, "
              "a_days_after_anchor long, a_in_window boolean, a_updated boolean, "
              "b_days_after_anchor long, b_in_window boolean, b_updated boolean")
    return spark.createDataFrame(rows, schema)


def rows_of(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    return [(1, t, "X", "M", True, 5, True, True, None, False, False),
            (2, t, "X", None, False, 3, True, True, 15, True, True),
            (3, t, "Y", "F", True, None, False, False, 30, False, True),
            (4, t, "Z", "F", False, 1, True, True, 12, True, True)]


def test_fit_on_train_only_unseen_and_null_codes(spark):
    df = tracked(spark, rows_of(spark))
    train = df.where("entity_id IN (1, 2, 3)")
    m = FE.FeatureModel.fit(train, SPEC, "y", rate_cols=("state",), code_cols=("state", "gender"))
    out = {r["entity_id"]: r for r in m.transform(df, scale=False).collect()}
    assert out[4]["state_encoded"] == -1 and out[4]["state_target_rate"] == 0.5   # unseen Z
    assert out[1]["state_target_rate"] == 0.5 and out[3]["state_target_rate"] == 1.0
    # NULL gender is its own class ('Unknown' sorts after 'F', 'M')
    assert out[2]["gender_encoded"] == 2 and out[3]["gender_encoded"] == 0
    assert out[3]["a_time_to_update"] == 999.0 and out[3]["a_missing"] == 1
    assert out[1]["b_missing"] == 1 and out[1]["gap_a_to_b"] == 994.0
    # perturbing a test row leaves the fitted lookups unchanged
    df2 = tracked(spark, [r if r[0] != 4 else (4, r[1], "X", "M", True, *r[5:]) for r in rows_of(spark)])
    m2 = FE.FeatureModel.fit(df2.where("entity_id IN (1, 2, 3)"), SPEC, "y", ("state",), ("state", "gender"))
    assert sorted(m.rates.collect()) == sorted(m2.rates.collect())


def test_scaler_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    mom = FE.fit_moments(df, ["x", "c"])
    assert mom["x"][1] == pytest.approx((2 / 3) ** 0.5)
    out = [r["c"] for r in FE.apply_moments(df, mom).collect()]
    assert out == [0.0, 0.0, 0.0]


def test_parity_defaults_and_leakage_flag(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 1.0)], "y int, leak double")
    out = FE.ensure_parity(df, ["leak", "zz_encoded", "q_target_rate", "other"]).first()
    assert out["zz_encoded"] == 0.5 and out["q_target_rate"] == 0.5 and out["other"] == 0.0
    lc = FE.leakage_correlations(df, ["leak"], "y").first()
    assert lc["flagged"] is True and lc["corr"] == pytest.approx(1.0)


def test_medians_from_train_only(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    test = spark.createDataFrame([(None,), (100.0,)], "x double")
    med = FE.fit_medians(train, ["x"])
    assert med == {"x": 2.5}
    assert [r["x"] for r in FE.apply_medians(test, med).collect()] == [2.5, 100.0]


def test_label_codes_high_cardinality_shared_prefix(spark):
    vals = [f"NATION_{i}" for i in range(3000)] + ["ALPHA", "zeta"]
    df = spark.createDataFrame([(v, v[-1]) for v in vals] + [(None, "x")], "a string, b string")
    codes = {(r["col_name"], r["value"]): r["code"] for r in FE.fit_label_codes(df, ["a", "b"]).collect()}
    exp_a = sorted(vals + ["Unknown"], key=lambda s: s.encode())
    assert [codes[("a", v)] for v in exp_a] == list(range(len(exp_a)))
    exp_b = sorted({v[-1] for v in vals} | {"x"}, key=lambda s: s.encode())
    assert [codes[("b", v)] for v in exp_b] == list(range(len(exp_b)))


def test_null_and_string_labels_stay(spark):
    rows = [(i, ["a", "b", None][i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, y string")
    s = splits.stratified_split(df, "id", "y").collect()
    assert len(s) == 90 and {r["split"] for r in s if r["y"] is None} == {None}
    for y in "ab":
        assert sum(r["split"] == "test" for r in s if r["y"] == y) == 6
    f = splits.stratified_folds(df, "id", "y", k=5).collect()
    assert len(f) == 90 and {r["fold"] for r in f if r["y"] is None} == {None}
    for y in "ab":
        assert sorted([sum(r["fold"] == k for r in f if r["y"] == y) for k in range(5)]) == [6] * 5


def test_unlabelled_rows_are_refused_by_training_and_curves(spark):
    from tollgate.operators import metrics, models
    with pytest.raises(ValueError, match="1 rows"):
        models.with_class_weights(spark.createDataFrame([(1,), (0,), (None,)], "y int"), "y")
    df = spark.createDataFrame([(1, 0.5), (0, None), (None, 0.2), (0, 0.1)], "label int, score double")
    with pytest.raises(ValueError, match="2 rows"):
        metrics.score_curve(df)


def test_medians_of_many_columns_take_as_many_jobs_as_one(spark):
    df = spark.range(300).selectExpr(*[f"CASE WHEN id % {k + 2} = 0 THEN NULL ELSE CAST(id * {k + 1} AS DOUBLE) END AS c{k}" for k in range(12)])
    import numpy as np
    tracker = spark.sparkContext.statusTracker()

    def jobs(cols):
        spark.sparkContext.setJobGroup(f"medians-{len(cols)}", "")
        got = FE.fit_medians(df, cols)
        n = len(tracker.getJobIdsForGroup(f"medians-{len(cols)}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return n, got
    one, _ = jobs(["c0"])
    many, got = jobs([f"c{k}" for k in range(12)])
    assert many <= one + 2
    for k in range(12):
        assert got[f"c{k}"] == float(np.median([i * (k + 1) for i in range(300) if i % (k + 2)]))


def test_lookups_join_once_per_column_and_broadcast(spark):
    rows = [(i, ["A", "B", None][i % 3], f"d{i % 7}", "Urban" if i % 2 else None, "MF"[i % 2], bool(i % 4)) for i in range(70)]
    df = spark.createDataFrame(rows, "id long, state string, district string, urban_rural string, gender string, y boolean")
    cols = ("state", "district", "urban_rural")
    codes = FE.fit_label_codes(df, ("gender", *cols))
    rates = FE.fit_target_rates(df, cols, "y")
    both = FE.written_lookup(rates.join(codes, ["col_name", "value"], "full"))
    one = FE.apply_lookups(df, both, cols, ("gender", *cols))
    two = FE.apply_label_codes(FE.apply_target_rates(df, rates, cols), codes, ("gender", *cols))
    assert sorted(map(str, one.select(sorted(one.columns)).collect())) == sorted(map(str, two.select(sorted(two.columns)).collect()))
    plan = one._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan
