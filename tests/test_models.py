import pytest
from pyspark.sql import functions as F

from tollgate.operators import models as MD


def test_sampled_shapley_efficiency_and_linear_attribution(spark):
    df = spark.range(400).select(
        F.col("id").alias("k"),
        (F.col("id") % 7 / 3.0).alias("x1"), (F.col("id") % 5 / 2.0 - 1).alias("x2"),
        (F.col("id") % 3).cast("double").alias("x3"),
        ((F.col("id") % 7 + F.col("id") % 3) > 4).cast("int").alias("y"))
    names = ["x1", "x2", "x3"]
    m = MD.train_logistic(df, names, "y", max_iter=50)
    rows = df.where("k < 20")
    phi = MD.sampled_shapley(m, rows, names, "k", {n: 0.0 for n in names}, n_perm=3)
    sums = {r["k"]: r["s"] for r in phi.groupBy("k").agg(F.sum("phi").alias("s")).collect()}
    px = {r["k"]: r["score"] for r in MD.score(m, rows, names).collect()}
    base = MD.score(m, spark.createDataFrame([(0, 0.0, 0.0, 0.0)], "k long, x1 double, x2 double, x3 double"),
                    names).first()["score"]
    assert set(sums) == set(range(20))
    for k, s in sums.items():
        assert s == pytest.approx(px[k] - base, abs=1e-9)       # efficiency: deltas telescope
    la = MD.linear_attribution(rows, "k", {"x1": 2.0})
    tot = la.agg(F.sum("contribution")).first()[0]
    assert tot == pytest.approx(0.0, abs=1e-9)                   # centred at the mean


def test_choose_best_rules():
    assert MD.choose_best({"lr": 0.9, "rf": 0.7}) == "rf"          # preference order gbt > rf > lr
    assert MD.choose_best({"lr": 0.9, "rf": 0.7}, rule="auc") == "lr"


def test_calibrated_scores_are_probabilities(spark):
    from tollgate.operators.metrics import ranking_metrics
    df = spark.range(600).select(
        F.col("id").alias("k"), (F.col("id") % 11 / 5.0).alias("x1"), (F.col("id") % 4).cast("double").alias("x2"),
        ((F.col("id") % 11) > 5).cast("int").alias("y"))
    pairs = MD.fit_calibrated(df, ["x1", "x2"], "y", "k", base="lr", folds=3)
    assert len(pairs) == 3
    s = MD.score_calibrated(pairs, df, ["x1", "x2"], "k").collect()
    assert len(s) == 600 and all(0.0 <= r["score"] <= 1.0 for r in s)
    auc = ranking_metrics(spark.createDataFrame([(r["y"], r["score"]) for r in s], "label int, score double"))
    assert auc.first()["roc_auc"] > 0.9


def test_temporal_validation_refuses_an_empty_side(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), 0.0, 1)], "t timestamp, x double, y int")
    with pytest.raises(ValueError, match="0 test rows"):
        MD.temporal_validation(df, ["x"], "y", "t", 2021)


def test_calibrated_scores_keep_rows_and_columns(spark):
    rows = [(i, float(i % 7), (i * 5 % 7) > 3) for i in range(120)]
    df = spark.createDataFrame(rows, "k long, x1 double, y boolean").selectExpr("k", "x1", "cast(y as int) as y")
    pairs = MD.fit_calibrated(df, ["x1"], "y", "k", base="lr", folds=3)
    both = df.unionByName(df)                                    # repeated keys do not multiply
    s = MD.score_calibrated(pairs, both, ["x1"], "k")
    assert s.columns == ["k", "x1", "y", "score"] and s.count() == 240


def anchorless_table(spark, n=240):
    """Tracked entities; every 40th has no anchor and no step, so its anchor features are NULL."""
    return spark.range(n).selectExpr(
        "id AS entity_id", "CASE WHEN id % 40 <> 0 THEN timestamp'2020-01-01' + make_interval(0, 0, 0, cast(id % 700 as int)) END AS anchor_ts",
        "concat('s', id % 3) AS state", "concat('d', id % 6) AS district", "if(id % 2 = 0, 'Urban', 'Rural') AS urban_rural",
        "if(id % 5 < 2, 'M', 'F') AS gender",
        *[x for s, m in (("a", 7), ("b", 4)) for x in (
            f"if(id % 40 <> 0 AND id % {m} > 1, cast(id % {m} * 3 as long), NULL) AS {s}_days_after_anchor",
            f"id % 40 <> 0 AND id % {m} > 2 AS {s}_in_window", f"id % 40 <> 0 AND id % {m} > 1 AS {s}_updated")],
        "id % 40 = 0 OR id % 7 <= 2 AS transition_failure")


@pytest.fixture(scope="module")
def anchorless(spark):
    from tollgate.operators import features as FE
    from tollgate.spec import CascadeSpec, StepWindow
    df = anchorless_table(spark)
    spec = CascadeSpec(steps=(StepWindow("a", "a", 0, 10), StepWindow("b", "b", 0, 10)))
    fm = FE.FeatureModel.fit(df.where("entity_id >= 10"), spec)
    f = fm.transform(df).withColumn("label", F.col("transition_failure").cast("int")).checkpoint(eager=True)
    return df, fm, f


def test_missing_anchors_become_training_medians(spark, anchorless):
    df, fm, f = anchorless
    assert {"anchor_year", "anchor_month", "anchor_quarter", "anchor_dow"} <= set(fm.medians)
    months = sorted(r[0] for r in df.where("entity_id >= 10 AND anchor_ts IS NOT NULL").select(F.month("anchor_ts")).collect())
    k = len(months)
    median = (months[(k - 1) // 2] + months[k // 2]) / 2
    mean, sd = fm.moments["anchor_month"]
    assert f.where("entity_id = 40").first()["anchor_month"] == pytest.approx((median - mean) / sd)
    whole = f.agg(*[F.count(F.when(F.col(n).isNull() | F.isnan(F.col(n).cast("double")), 1)).alias(n) for n in fm.feature_names]).first()
    assert f.count() == 240 and not any(whole)


@pytest.mark.parametrize("kind, over", [("lr", {}), ("rf", {"numTrees": 5}), ("gbt", {"maxIter": 3})])
def test_trainers_take_entities_without_anchor(spark, anchorless, kind, over):
    _, fm, f = anchorless
    model = MD.TRAINERS[kind](f, fm.feature_names, "label", **over)
    s = MD.score(model, f, fm.feature_names).select("entity_id", "score").collect()
    assert len(s) == 240 and all(0.0 <= r.score <= 1.0 for r in s)


def test_calibration_and_saved_bundle_take_entities_without_anchor(spark, anchorless, tmp_path):
    from tollgate.operators.scoring import ScoringBundle
    df, fm, f = anchorless
    names = [n for n in fm.feature_names if "anchor" in n or "_encoded" in n or "_target_rate" in n]
    pairs = MD.fit_calibrated(f, names, "label", "entity_id", base="lr", folds=2)
    assert MD.score_calibrated(pairs, f, names, "entity_id").count() == 240
    ScoringBundle(fm, None, names, {"kind": "test"}, pairs).save(str(tmp_path / "bundle"))
    loaded = ScoringBundle.load(spark, str(tmp_path / "bundle"))
    assert loaded.features.medians == fm.medians
    got = {r.entity_id: r for r in loaded.score(df).collect()}
    assert len(got) == 240 and got[40].error == "Missing required field: anchor_ts"
    assert all((r.probability is None) == (k % 40 == 0) for k, r in got.items())
    free = {r.entity_id: r for r in loaded.score(df, required=("gender",)).collect()}  # medians stand in
    want = {r.entity_id: r.score for r in MD.score_calibrated(pairs, f, names, "entity_id").collect()}
    assert all(free[k].probability == pytest.approx(want[k]) for k in want)


def test_infinite_values_count_as_missing(spark):
    from tollgate.operators import features as FE
    df = spark.createDataFrame([(1.0,), (3.0,), (float("inf"),), (float("nan"),), (None,), (8.0,)], "x double")
    med = FE.fit_medians(df, ["x"])
    assert med == {"x": 3.0}
    assert sorted(r.x for r in FE.apply_medians(df, med).collect()) == [1.0, 3.0, 3.0, 3.0, 3.0, 8.0]


def test_independent_fits_run_at_once(spark, monkeypatch):
    import threading

    def meets(n):
        gate, plain = threading.Barrier(n), MD.train_logistic

        def train(*args, **over):
            gate.wait(timeout=60)  # broken unless n fits are under way
            return plain(*args, max_iter=5)
        monkeypatch.setitem(MD.TRAINERS, "met", train)
    df = spark.range(90).selectExpr("id AS k", "id % 7 / 3.0 AS x1", "id % 5 - 1.0 AS x2", "cast(id % 7 > 3 as int) AS y")
    meets(3)
    mean, _, aucs = MD.cv_auc(df, ["x1", "x2"], "y", "k", "met", k=3)
    assert len(aucs) == 3 and mean == pytest.approx(sum(aucs) / 3)
    meets(2)
    assert [r[0] for r in MD.ablation(df, df, ["x1", "x2"], {"b": ["x2"]}, "y", "met")] == ["<none>", "b"]
    meets(3)
    assert len(MD.fit_calibrated(df, ["x1", "x2"], "y", "k", base="met", folds=3)) == 3
    assert MD.side_by_side(spark, [lambda i=i: i for i in range(9)]) == list(range(9))


def test_sampled_shapley_shuffles_no_vectors_and_shares_repeated_keys(spark):
    df = spark.range(60).selectExpr("id AS k", "id % 7 / 3.0 AS x1", "id % 5 - 1.0 AS x2", "cast(id % 7 > 3 as int) AS y")
    names = ["x1", "x2"]
    m = MD.train_random_forest(df, names, "y", numTrees=5, maxDepth=3)
    zero = {n: 0.0 for n in names}
    phi = MD.sampled_shapley(m, df, names, "k", zero, n_perm=4)
    plan = phi._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
    one = {(r.k, r.feature): r.phi for r in phi.collect()}
    twice = {(r.k, r.feature): r.phi for r in MD.sampled_shapley(m, df.unionByName(df), names, "k", zero, n_perm=4).collect()}
    assert len(one) == 120 and all(twice[at] == pytest.approx(v / 2, abs=1e-12) for at, v in one.items())
