"""Model queries on B1 features (M2-M15, E13, R1-R4, S7, K7).  MLlib training has no
SQL formulation, so fits carry no oracle (rows-only check); their metric parts reuse
the SQL-checked metric operators, and what SQL can say of them (sizes, errors) is split off
into queries with an oracle."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import functions as F

from ..operators import attribution, audit, boosting, models as MD, solvers, splits
from ..operators.features import day0_feature_names
from ..operators.metrics import evaluation, ranking_metrics
from ..operators.scoring import ScoringBundle, scoring_summary
from ..session import scratch_path
from .catalog import register
from .sqlgen import tracked_ctes
from .q_cascade import rsql
from .q_features import SPEC, TARGET, feature_names, fitted, fitted_sql, split_sql

KEY = "entity_id"


def model_frame(spark, sf_dir):
    """Split + train-fitted, scaled feature matrix of every customer."""
    s, m = fitted(spark, sf_dir)
    f = m.transform(s).withColumn("label", F.col(TARGET).cast("int"))
    # every model query fits several times over this matrix: write it once to the
    # shared checkpoint folder (cuts the lineage; survives executor loss)
    return f.checkpoint(eager=True), m


def _test_scores(model, f, names, tag):
    s = MD.score(model, f.where(F.col("split") == "test"), names)
    return s.select(F.lit(tag).alias("model"), KEY, "label", "score")


@register("train_lr")
def train_lr(spark, sf_dir):
    """M3: balanced L2 logistic regression on all features; test-split scores."""
    f, m = model_frame(spark, sf_dir)
    lr = MD.train_logistic(f.where(F.col("split") == "train"), m.feature_names, "label")
    return _test_scores(lr, f, m.feature_names, "lr")


@register("train_rf")
def train_rf(spark, sf_dir):
    """M4: random forest with the reference's hyper-parameters; test-split scores."""
    f, m = model_frame(spark, sf_dir)
    rf = MD.train_random_forest(f.where(F.col("split") == "train"), m.feature_names, "label")
    return _test_scores(rf, f, m.feature_names, "rf")


@register("train_gbt")
def train_gbt(spark, sf_dir):
    """M5 / M8 (diagnostic model): boosted trees on all features; test-split scores."""
    f, m = model_frame(spark, sf_dir)
    g = MD.train_gbt(f.where(F.col("split") == "train"), m.feature_names, "label")
    return _test_scores(g, f, m.feature_names, "gbt")


#: Rounds of the registered second-order fit (a job a level and round; ``fit_boosted`` takes 100 by default).
BOOST_ROUNDS = 20


@register("train_boosted")
def train_boosted(spark, sf_dir):
    """M5: second-order boosting on all features (depth 6, rate 0.1, 0.8 row and column sampling,
    ``BOOST_ROUNDS`` rounds); test-split scores."""
    f, m = model_frame(spark, sf_dir)
    g = boosting.fit_boosted(f.where(F.col("split") == "train"), m.feature_names, "label", key=KEY, rounds=BOOST_ROUNDS)
    return _test_scores(g, f, m.feature_names, "boosted")


FLAGS = [f"{s.name}_in_window" for s in SPEC.steps]


@register("boosted_first_split", rsql(f"""{tracked_ctes('customers')},
  f AS (SELECT unnest(['anchor_month', 'anchor_day', {', '.join(f"'{c}'" for c in FLAGS)}]) AS feature,
               unnest([month(anchor_ts), day(anchor_ts), {', '.join(f'CAST({c} AS INTEGER)' for c in FLAGS)}]) AS x,
               CAST({TARGET} AS INTEGER) AS y FROM tracked WHERE anchor_ts IS NOT NULL AND {TARGET} IS NOT NULL),
  v AS (SELECT feature, x, count(*) AS n, sum(0.5 - y) AS g FROM f GROUP BY feature, x),
  c AS (SELECT feature, x, sum(n) OVER (PARTITION BY feature ORDER BY x) AS nl, sum(g) OVER (PARTITION BY feature ORDER BY x) AS gl,
               sum(n) OVER (PARTITION BY feature) AS n, sum(g) OVER (PARTITION BY feature) AS g FROM v),
  s AS (SELECT *, CAST(gl * gl AS DOUBLE) / (0.25 * nl + 1) + CAST((g - gl) * (g - gl) AS DOUBLE) / (0.25 * (n - nl) + 1)
                  - CAST(g * g AS DOUBLE) / (0.25 * n + 1) AS gain FROM c WHERE nl >= 4 AND n - nl >= 4)
  SELECT feature, CAST(x AS DOUBLE) AS cut, CAST(n AS BIGINT) AS n, CAST(nl AS BIGINT) AS n_left, gain FROM s
  QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, x) = 1""", ["gain"]))
def boosted_first_split(spark, sf_dir):
    """M5 split finding alone: of each feature, the cut of highest gain at the root of the first tree."""
    from .q_cascade import tracked_customers
    names = ["anchor_month", "anchor_day", *FLAGS]
    t = tracked_customers(spark, sf_dir).where(F.col("anchor_ts").isNotNull() & F.col(TARGET).isNotNull()).select(
        KEY, F.month("anchor_ts").alias("anchor_month"), F.dayofmonth("anchor_ts").alias("anchor_day"),
        *[F.col(c).cast("int").alias(c) for c in FLAGS], F.col(TARGET).cast("int").alias("label")).checkpoint(eager=True)
    cuts = boosting.quantile_cuts(t, names)
    data = boosting.binned(t, names, "label", cuts, KEY)
    best = boosting.best_splits(data, len(names), [], boosting.Tree(), [0], list(range(len(names))), 0, 256).where("best IS NOT NULL")
    at = F.element_at(F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in c]).cast("array<double>") for c in cuts]), F.col("feature") + 1),
                      1 - F.col("best.minus_at"))
    return best.select(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("feature") + 1).alias("feature"), at.alias("cut"), "n",
                       F.round(F.col("best.hl") / 0.25).cast("long").alias("n_left"), F.col("best.gain").alias("gain"))


@register("calibrated_suite")
def calibrated_suite(spark, sf_dir):
    """M6 + M7: Day-0 models (LR, RF, GBT), each isotonic-calibrated over 3 folds;
    calibrated test-split scores of every model, long form."""
    f, m = model_frame(spark, sf_dir)
    names = day0_feature_names(m.feature_names)
    train, test = f.where(F.col("split") == "train"), f.where(F.col("split") == "test")
    bases = ("lr", "rf", "gbt")
    fits = MD.side_by_side(spark, [partial(MD.fit_calibrated, train, names, "label", KEY, base=b, folds=3) for b in bases])
    scores = [MD.score_calibrated(pairs, test.select(KEY, "label", *names), names, KEY).select(
        F.lit(b).alias("model"), KEY, "label", "score") for b, pairs in zip(bases, fits)]
    return reduce(lambda a, b: a.unionByName(b), scores)


@register("day0_evaluation")
def day0_evaluation(spark, sf_dir):
    """M7: accuracy, precision, recall, F1, AUC and Brier score of each calibrated Day-0 model
    on the test split."""
    return evaluation(calibrated_suite(spark, sf_dir).checkpoint(eager=True), ("lr", "rf", "gbt"))


@register("diagnostic_evaluation")
def diagnostic_evaluation(spark, sf_dir):
    """M8: the same measures of the diagnostic model (boosted trees on all features)."""
    return evaluation(train_gbt(spark, sf_dir).checkpoint(eager=True), ("gbt",))


@register("cv_auc")
def cv_auc(spark, sf_dir):
    """M2: 5-fold stratified cross-validated AUC of LR on the training split."""
    f, m = model_frame(spark, sf_dir)
    mean, std, aucs = MD.cv_auc(f.where(F.col("split") == "train"), m.feature_names, "label", KEY, "lr", k=5)
    return spark.createDataFrame([(i, a, mean, std) for i, a in enumerate(aucs)],
                                 "fold int, roc_auc double, mean_auc double, std_auc double")


def _cv_trees(spark, sf_dir, trainer):
    f, m = model_frame(spark, sf_dir)
    mean, std, aucs = MD.cv_auc(f.where(F.col("split") == "train"), m.feature_names, "label", KEY, trainer, k=5)
    return spark.createDataFrame([(trainer, i, a, mean, std) for i, a in enumerate(aucs)],
                                 "model string, fold int, roc_auc double, mean_auc double, std_auc double")


@register("cv_auc_rf")
def cv_auc_rf(spark, sf_dir):
    """M2: 5-fold stratified cross-validated AUC of the random forest on the training split."""
    return _cv_trees(spark, sf_dir, "rf")


@register("cv_auc_gbt")
def cv_auc_gbt(spark, sf_dir):
    """M2: 5-fold stratified cross-validated AUC of the boosted trees on the training split."""
    return _cv_trees(spark, sf_dir, "gbt")


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """Random-forest feature importances, sorted."""
    f, m = model_frame(spark, sf_dir)
    rf = MD.train_random_forest(f.where(F.col("split") == "train"), m.feature_names, "label")
    return MD.feature_importances(rf, m.feature_names, spark)


@register("sampled_shapley")
def sampled_shapley(spark, sf_dir):
    """Sampled-permutation Shapley values of the random forest for all test rows
    (baseline = training mean, i.e. 0 after scaling)."""
    f, m = model_frame(spark, sf_dir)
    names = m.feature_names
    rf = MD.train_random_forest(f.where(F.col("split") == "train"), names, "label")
    return MD.sampled_shapley(rf, f.where(F.col("split") == "test"), names, KEY, {n: 0.0 for n in names})


def _forest(spark, sf_dir):
    f, m = model_frame(spark, sf_dir)
    return f, m.feature_names, MD.train_random_forest(f.where(F.col("split") == "train"), m.feature_names, "label")


@register("tree_attribution")
def tree_attribution(spark, sf_dir):
    """Exact path-dependent Shapley values of the random forest, all test rows and features."""
    f, names, rf = _forest(spark, sf_dir)
    return attribution.tree_attribution(f.where(F.col("split") == "test"), attribution.path_table(spark, rf), names, KEY)


@register("tree_attribution_sums", f"""{split_sql()}
  SELECT entity_id, CAST({len(feature_names())} AS BIGINT) AS n_features, true AS adds_up FROM split WHERE split = 'test'""")
def tree_attribution_sums(spark, sf_dir):
    """M12 self-check: of every test row, the attributions of all features and whether they add up
    to the row's score less the expected score."""
    f, names, rf = _forest(spark, sf_dir)
    test, table = f.where(F.col("split") == "test"), attribution.path_table(spark, rf)
    sums = attribution.tree_attribution(test, table, names, KEY).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("phi").alias("total"))
    return MD.score(rf, test, names).select(KEY, "score").join(sums, KEY, "left").select(
        KEY, "n_features", (F.abs(F.col("total") - (F.col("score") - F.lit(table.expected))) < 1e-9).alias("adds_up"))


def _newton(spark, sf_dir):
    f, m = model_frame(spark, sf_dir)
    train = MD.with_class_weights(f.where(F.col("split") == "train"), "label")
    return f, m.feature_names, train, solvers.fit_newton(train, m.feature_names, "label", F.col("weight"))


@register("train_lr_newton")
def train_lr_newton(spark, sf_dir):
    """M3: the same balanced L2 logistic regression by Newton's method; test-split scores."""
    f, _, _, model = _newton(spark, sf_dir)
    return f.where(F.col("split") == "test").select(F.lit("lr").alias("model"), KEY, "label", model.probability().alias("score"))


@register("lr_gradient", f"""{fitted_sql()},
  t AS (SELECT count(*) AS n FROM feat WHERE split = 'train')
  SELECT unnest(list_concat({feature_names()}, ['(intercept)'])) AS feature, n, CAST(0.0 AS DOUBLE) AS gradient FROM t""")
def lr_gradient(spark, sf_dir):
    """M3: the gradient of the penalised weighted loss at the Newton solution, added up anew by
    column expressions over the training rows; zero (to 6 digits) at the optimum."""
    _, names, train, model = _newton(spark, sf_dir)
    off = F.col("weight") * (model.probability() - F.col("label"))
    sums = train.agg(F.count(F.lit(1)).alias("n"), *[F.sum(off * F.col(c).cast("double")).alias(f"g{i}") for i, c in enumerate(names)],
                     F.sum(off).alias("g"))
    rows = [F.struct(F.lit(c).alias("feature"), (F.col(f"g{i}") + F.lit(float(b))).alias("gradient"))
            for i, (c, b) in enumerate(zip(names, model.coefficients))]
    rows.append(F.struct(F.lit("(intercept)").alias("feature"), F.col("g").alias("gradient")))
    zero = F.round(F.col("gradient"), 6) + F.lit(0.0)  # -0.0 is 0.0
    return sums.select("n", F.inline(F.array(*rows))).select("feature", "n", zero.alias("gradient"))


@register("isotonic_calibration", rsql(f"""{tracked_ctes('customers')},
  g AS (SELECT CAST(high_days_after_anchor AS DOUBLE) AS x, count(*) AS n, sum(CAST(transition_failure AS INTEGER)) AS s
        FROM tracked WHERE high_days_after_anchor IS NOT NULL GROUP BY x),
  c AS (SELECT x, n, row_number() OVER (ORDER BY x) AS i, sum(n) OVER (ORDER BY x) AS cn, sum(s) OVER (ORDER BY x) AS cs FROM g),
  d AS (SELECT i, cn, cs FROM c UNION ALL SELECT 0, 0, 0),
  p AS (SELECT a.i AS a, b.i AS b, CAST(b.cs - a.cs AS DOUBLE) / (b.cn - a.cn) AS m FROM d a JOIN d b ON a.i < b.i),
  lowest AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM p)
  SELECT c.x AS score, CAST(c.n AS BIGINT) AS n, max(l.m) AS calibrated FROM c JOIN lowest l ON l.i = c.i GROUP BY c.x, c.n""", ["score", "calibrated"]))
def isotonic_calibration(spark, sf_dir):
    """M6 alone: the increasing map from the days until the second step to the failure rate."""
    from .q_cascade import tracked_customers
    t = tracked_customers(spark, sf_dir).where(F.col("high_days_after_anchor").isNotNull()).select(
        F.col("high_days_after_anchor").cast("double").alias("score"), F.col(TARGET).cast("int").alias("label")).checkpoint(eager=True)
    model = solvers.fit_isotonic(t, "score", "label", out="calibrated")
    return model.transform(t.groupBy("score").agg(F.count(F.lit(1)).alias("n"))).select("score", "n", "calibrated")


# fixed values: feature groups for the ablation (by name part)
ABLATION_GROUPS = ("time_to_update", "window_completed", "gap", "missing", "is_late", "_encoded",
                   "_target_rate", "anchor_")


@register("ablation")
def ablation(spark, sf_dir):
    """AUC drop when each feature group is removed (LR refits)."""
    f, m = model_frame(spark, sf_dir)
    groups = {g: [n for n in m.feature_names if g in n] for g in ABLATION_GROUPS}
    rows = MD.ablation(f.where(F.col("split") == "train"), f.where(F.col("split") == "test"), m.feature_names,
                       groups, "label", "lr")
    return spark.createDataFrame(rows, "removed_group string, roc_auc double, auc_drop double")


@register("temporal_validation")
def temporal_validation(spark, sf_dir):
    """Train on anchors up to the median anchor year, test on those of later years."""
    f, m = model_frame(spark, sf_dir)
    cutoff = _cutoff_year(f)
    n_train, n_test, auc = MD.temporal_validation(f, m.feature_names, "label", "anchor_ts", cutoff, "lr")
    return spark.createDataFrame([(cutoff, n_train, n_test, auc)], "cutoff_year int, n_train long, n_test long, roc_auc double")


def _cutoff_year(df) -> int:
    years = df.where(F.col("anchor_ts").isNotNull()).groupBy(F.year("anchor_ts").alias("y")).count().orderBy("y").collect()  # one row per year
    half, seen = sum(r["count"] for r in years) / 2, 0
    for r in years:
        seen += r["count"]
        if seen >= half:
            return r["y"] + 1
    raise ValueError("no anchors")


@register("temporal_sizes", f"""{tracked_ctes('customers')},
  c AS (SELECT CAST(quantile_disc(year(anchor_ts), 0.5) AS INTEGER) + 1 AS cutoff_year FROM tracked)
  SELECT cutoff_year, CAST(count(*) FILTER (WHERE year(anchor_ts) < cutoff_year) AS BIGINT) AS n_train,
         CAST(count(*) FILTER (WHERE year(anchor_ts) >= cutoff_year) AS BIGINT) AS n_test
  FROM tracked, c GROUP BY cutoff_year""")
def temporal_sizes(spark, sf_dir):
    """M14 without the fit: the cutoff year and the rows on either side."""
    from .q_cascade import tracked_customers
    t = tracked_customers(spark, sf_dir).select("anchor_ts").checkpoint(eager=True)
    cutoff = _cutoff_year(t)
    side = splits.temporal_split(t, "anchor_ts", cutoff)
    return t.agg(F.lit(cutoff).alias("cutoff_year"), F.count(F.when(side == "train", 1)).alias("n_train"),
                 F.count(F.when(side == "test", 1)).alias("n_test"))


@register("horizon_models")
def horizon_models(spark, sf_dir):
    """One model per availability horizon with the features known by then."""
    f, m = model_frame(spark, sf_dir)
    cls = audit.classify_names(m.feature_names, SPEC)
    horizons = sorted({h for _, h, _, _ in cls})
    by_h = {h: [n for n, hh, _, _ in cls if hh <= h] for h in horizons}
    rows = MD.horizon_models(f.where(F.col("split") == "train"), f.where(F.col("split") == "test"), by_h, "label")
    return spark.createDataFrame(rows, "horizon int, n_features int, roc_auc double")


@register("label_shuffle_check")
def label_shuffle_check(spark, sf_dir):
    """Accuracy of a model refit on permuted labels, against the permuted labels of the
    training and the test rows (leakage sanity check)."""
    f, m = model_frame(spark, sf_dir)
    at_train, acc, warn = MD.label_shuffle_check(f.where(F.col("split") == "train"), f.where(F.col("split") == "test"),
                                       m.feature_names, "label", KEY)
    return spark.createDataFrame([(at_train, acc, warn)], "train_accuracy double, shuffled_accuracy double, leakage_warning boolean")


@register("score_batch")
def score_batch(spark, sf_dir):
    """Train a Day-0 LR, save the bundle to the shared checkpoint
    folder, load it back once and score every customer as a request (rows with a
    missing required field keep an error instead of a score)."""
    f, m = model_frame(spark, sf_dir)
    names = day0_feature_names(m.feature_names)
    lr = MD.train_logistic(f.where(F.col("split") == "train"), names, "label")
    path = scratch_path(spark, "bundle")
    ScoringBundle(m, lr, names, {"trained_on": "customers", "target": TARGET}).save(path)
    bundle = ScoringBundle.load(spark, path)
    from .q_cascade import tracked_customers
    req = tracked_customers(spark, sf_dir).select(
        KEY, F.when(F.col(KEY) % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("gender")).alias("gender"),
        "state", "district", "urban_rural", "anchor_ts")
    return bundle.score(req)


def _errors_sql():
    """Each required field in turn, written out; ``gender`` is taken away from every 11th request."""
    missing = {"gender": "(gender IS NULL OR entity_id % 11 = 0)", "state": "state IS NULL", "district": "district IS NULL",
               "urban_rural": "urban_rural IS NULL", "anchor_ts": "anchor_ts IS NULL"}
    whens = " ".join(f"WHEN {c} THEN 'Missing required field: {n}'" for n, c in missing.items())
    return (f"{tracked_ctes('customers')} SELECT entity_id, CASE {whens} END AS error, "
            f"NOT ({' OR '.join(missing.values())}) AS scored FROM tracked")


@register("score_batch_errors", _errors_sql())
def score_batch_errors(spark, sf_dir):
    """R1/R2 without the probabilities: every request once, its error, and whether it got a score."""
    return score_batch(spark, sf_dir).select(KEY, "error", F.col("probability").isNotNull().alias("scored"))


@register("score_batch_summary")
def score_batch_summary(spark, sf_dir):
    """R2 counts (processed / failed / total) and the test AUC of the Day-0 scores."""
    scored = score_batch(spark, sf_dir)
    from .q_cascade import tracked_customers
    lab = tracked_customers(spark, sf_dir).select(KEY, F.col(TARGET).cast("int").alias("label"))
    s = scored.where(F.col("error").isNull()).join(lab, KEY).withColumnRenamed("probability", "score")
    auc = ranking_metrics(s, "label", "score").select("roc_auc")
    return _summary(scoring_summary(scored), auc)


def _summary(counts, auc):
    a = auc.first()["roc_auc"]
    return counts.withColumn("roc_auc", F.lit(a).cast("double"))


@register("model_info")
def model_info(spark, sf_dir):
    """R4 + M9: train Day-0 LR and RF, pick the deployment model by the reference's
    preference rule, save and reload its bundle, and report its information."""
    from ..operators.metrics import ranking_metrics as rm
    f, m = model_frame(spark, sf_dir)
    names = day0_feature_names(m.feature_names)
    train, test = f.where(F.col("split") == "train"), f.where(F.col("split") == "test")
    fitted_models = {"lr": MD.train_logistic(train, names, "label"),
                     "rf": MD.train_random_forest(train, names, "label")}
    aucs = {k: rm(MD.score(v, test, names), "label", "score").first()["roc_auc"] for k, v in fitted_models.items()}
    best = MD.choose_best(aucs)
    path = scratch_path(spark, "bundle-info")
    ScoringBundle(m, fitted_models[best], names, {"chosen": best, "test_auc": aucs[best]}).save(path)
    return ScoringBundle.load(spark, path).info(spark)
