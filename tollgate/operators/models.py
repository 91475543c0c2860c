"""Spark ML models, calibration, validation and attribution (M3-M16); exact tree attribution is in
``attribution``, Newton's method and distributed isotonic pooling in ``solvers``, second-order boosting in
``boosting``.

Training is MLlib (distributed).  Everything around it -- class weights, folds,
out-of-fold calibration, cross-validated AUC, label-shuffle sanity, ablation,
temporal and per-horizon validation, sampled Shapley values -- is DataFrame work over
the same partitioned data; the driver only starts a handful of model fits, independent ones
side by side.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import md5_order_key
from ..session import checkpoint_dir
from .boosting import fit_boosted
from .features import vector_column
from .metrics import ranking_metrics
from .solvers import fit_isotonic
from .splits import shuffled_labels, stratified_folds

# fixed values: the reference's hyper-parameters
RF_PARAMS = dict(numTrees=100, maxDepth=10, minInstancesPerNode=10, seed=42)
GBT_PARAMS = dict(maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, seed=42)
LR_MAX_ITER = 1000
LR_TOL = 1e-4  # sklearn's lbfgs tolerance
#: Independent fits at once.  A fit is hundreds of short jobs, one after another, that leave cores idle.
FITS_AT_ONCE = 5


def side_by_side(spark: SparkSession, tasks: list[Callable]) -> list:
    """The results of independent tasks in their order, ``FITS_AT_ONCE`` running at a time."""
    checkpoint_dir(spark)
    with ThreadPool(max(1, min(FITS_AT_ONCE, len(tasks)))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(spark)(t) for t in tasks], chunksize=1)


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """'balanced' weights n / (classes * n_class), from one count of one row per class.
    Rows with a NULL label cannot be weighed or trained on: they raise."""
    counts = {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc")).collect()}
    if counts.get(None):
        raise ValueError(f"{counts[None]} rows have a NULL label")
    weight = F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col(label) == F.lit(value), F.lit(sum(counts.values()) / (len(counts) * n))).otherwise(weight)
    return df.withColumn(out, weight)


def prepare(df: DataFrame, names, label: str) -> DataFrame:
    """assemble features and cast the label to double for MLlib."""
    return vector_column(df, names).withColumn("__label", F.col(label).cast("double"))


def train_logistic(train: DataFrame, names, label: str, balanced: bool = True, max_iter: int = LR_MAX_ITER):
    """M3: L2 logistic regression with regParam 1/n (sklearn C=1 on averaged loss),
    no internal standardisation (features are already scaled), balanced weights."""
    d = prepare(train, names, label)
    n = d.count()
    kw = {}
    if balanced:
        d = with_class_weights(d, label)
        kw["weightCol"] = "weight"
    lr = LogisticRegression(featuresCol="features", labelCol="__label", maxIter=max_iter, regParam=1.0 / max(n, 1),
                            elasticNetParam=0.0, standardization=False, tol=LR_TOL, **kw)
    return lr.fit(d)


def train_random_forest(train: DataFrame, names, label: str, **over):
    """M4: random forest (100 trees, depth 10, min 10 rows per leaf, sqrt features)."""
    p = {**RF_PARAMS, **over}
    rf = RandomForestClassifier(featuresCol="features", labelCol="__label", featureSubsetStrategy="sqrt", **p)
    return rf.fit(prepare(train, names, label))


def train_gbt(train: DataFrame, names, label: str, **over):
    """M5: gradient-boosted trees (depth 6, rate 0.1, 100 rounds, 0.8 row/column sampling)."""
    p = {**GBT_PARAMS, **over}
    gbt = GBTClassifier(featuresCol="features", labelCol="__label", featureSubsetStrategy="0.8", **p)
    return gbt.fit(prepare(train, names, label))


def train_boosted(train: DataFrame, names, label: str, **over):
    """M5: the same boosting with second-order leaf weights and quantile bins (``boosting``)."""
    return fit_boosted(train, names, label, **over)


TRAINERS = {"lr": train_logistic, "rf": train_random_forest, "gbt": train_gbt, "boosted": train_boosted}


def score(model, df: DataFrame, names, out: str = "score") -> DataFrame:
    """Probability of class 1 as a plain double column."""
    d = vector_column(df, names)
    return model.transform(d).withColumn(out, vector_to_array(F.col("probability"))[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def fit_calibrated(train: DataFrame, names, label: str, key: str, base: str = "rf", folds: int = 3,
                   seed: int = 42, **over):
    """M6: for each of ``folds`` stratified folds, fit the base model on the other folds
    and an isotonic map on this fold's out-of-fold scores (``solvers.fit_isotonic``: no score
    reaches the driver); returns the pairs."""
    checkpoint_dir(train.sparkSession)
    f = stratified_folds(train, key, label, k=folds, seed=seed).checkpoint(eager=True)  # read by every fold

    def pair(i):
        m = TRAINERS[base](f.where(F.col("fold") != i), names, label, **over)
        s = score(m, f.where(F.col("fold") == i), names).withColumn("__label", F.col(label).cast("double"))
        return m, fit_isotonic(s, "score", "__label", out="cal")
    return side_by_side(train.sparkSession, [partial(pair, i) for i in range(folds)])


def score_calibrated(pairs, df: DataFrame, names, key: str, out: str = "score") -> DataFrame:
    """M6 apply: mean of the calibrated probabilities of every (base, isotonic) pair, as a
    chain of transforms over one DataFrame."""
    cols, d = df.columns, df
    for i, (m, iso) in enumerate(pairs):
        iso = iso.copy().setFeaturesCol(f"__s{i}").setPredictionCol(f"__c{i}")
        d = iso.transform(score(m, d, names, out=f"__s{i}"))
    mean = sum((F.col(f"__c{i}") for i in range(len(pairs))), F.lit(0.0)) / F.lit(float(len(pairs)))
    return d.select(*[F.col(c) for c in cols if c != out], mean.alias(out))


def cv_auc(df: DataFrame, names, label: str, key: str, trainer: str = "lr", k: int = 5, seed: int = 42, **over):
    """M2: k-fold stratified cross-validated ROC AUC: (mean, std, per-fold list)."""
    checkpoint_dir(df.sparkSession)
    f = stratified_folds(df, key, label, k=k, seed=seed).checkpoint(eager=True)  # read by every fold

    def auc_of(i):
        m = TRAINERS[trainer](f.where(F.col("fold") != i), names, label, **over)
        s = score(m, f.where(F.col("fold") == i), names).withColumn("label", F.col(label).cast("int"))
        return ranking_metrics(s, "label", "score").first()["roc_auc"]
    aucs = side_by_side(df.sparkSession, [partial(auc_of, i) for i in range(k)])
    mean = sum(aucs) / k
    std = math.sqrt(sum((a - mean) ** 2 for a in aucs) / k)
    return mean, std, aucs


def feature_importances(model, names, spark) -> DataFrame:
    """(feature, importance) sorted desc, ties by name (one row per feature)."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double") \
        .orderBy(F.desc("importance"), F.asc("feature"))


def accuracy_at(df: DataFrame, label: str, score_col: str = "score", threshold: float = 0.5) -> float:
    return df.agg(F.avg(((F.col(score_col) >= threshold).cast("int") == F.col(label).cast("int"))
                        .cast("double"))).first()[0]


def label_shuffle_check(train: DataFrame, test: DataFrame, names, label: str, key: str, seed: int = 42,
                        warn_above: float = 0.6):
    """Refit LR on permuted training labels and score it against the permuted labels of
    either side; test accuracy above ``warn_above`` signals leakage.  Returns (train
    accuracy, test accuracy, warning)."""
    def permuted(df):
        sh = shuffled_labels(df, key, label, seed=seed).drop(label).withColumnRenamed("shuffled_label", label)
        return df.drop(label).join(sh.select(key, label), key)
    tr, te = permuted(train), permuted(test)
    m = train_logistic(tr, names, label, max_iter=1000)
    at_train, at_test = (accuracy_at(score(m, d, names), label) for d in (tr, te))
    return at_train, at_test, at_test > warn_above


def ablation(train: DataFrame, test: DataFrame, names, groups: dict, label: str, trainer: str = "lr", **over):
    """AUC of the full model and of refits without each feature group."""
    def auc_of(cols):
        m = TRAINERS[trainer](train, cols, label, **over)
        s = score(m, test, cols).withColumn("label", F.col(label).cast("int"))
        return ranking_metrics(s, "label", "score").first()["roc_auc"]
    kept = [list(names), *[[n for n in names if n not in set(cols)] for cols in groups.values()]]
    full, *aucs = side_by_side(train.sparkSession, [partial(auc_of, cols) for cols in kept])
    return [("<none>", full, 0.0), *[(g, a, full - a) for g, a in zip(groups, aucs)]]


def temporal_validation(df: DataFrame, names, label: str, ts_col: str, cutoff_year: int, trainer: str = "lr",
                        **over):
    """Train on anchors before ``cutoff_year``, evaluate on the rest.  Returns (training
    rows, test rows, test AUC); a side without rows raises."""
    y = F.year(F.col(ts_col))
    train, test = df.where(y < cutoff_year), df.where(y >= cutoff_year)
    n_train, n_test = train.count(), test.count()
    if not n_train or not n_test:
        raise ValueError(f"year {cutoff_year} leaves {n_train} training and {n_test} test rows")
    m = TRAINERS[trainer](train, names, label, **over)
    s = score(m, test, names).withColumn("label", F.col(label).cast("int"))
    return n_train, n_test, ranking_metrics(s, "label", "score").first()["roc_auc"]


def horizon_models(train: DataFrame, test: DataFrame, names_by_horizon: dict, label: str, trainer: str = "lr",
                   **over):
    """One model per prediction horizon using the features known by then."""
    out = []
    for h in sorted(names_by_horizon):
        cols = names_by_horizon[h]
        if not cols:
            continue
        m = TRAINERS[trainer](train, cols, label, **over)
        s = score(m, test, cols).withColumn("label", F.col(label).cast("int"))
        out.append((h, len(cols), ranking_metrics(s, "label", "score").first()["roc_auc"]))
    return out


def choose_best(aucs: dict, rule: str = "prefer", order=("gbt", "rf", "lr")) -> str:
    """M9: the model to deploy.  ``prefer`` takes the first available model of
    ``order`` (the reference's boosted-trees-else-forest rule); ``auc`` the highest AUC."""
    if rule == "auc":
        return max(sorted(aucs), key=lambda k: aucs[k])
    for m in order:
        if m in aucs:
            return m
    raise ValueError("no model available")


def linear_attribution(x: DataFrame, key: str, coefs: dict) -> DataFrame:
    """M12 (linear models): exact contribution coef * (x - mean(x)) per row and
    feature, long form.  Means come from one aggregate (a single row)."""
    means = x.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in coefs]).first()
    structs = [F.struct(F.lit(c).alias("feature"),
                        (F.lit(w) * (F.col(c).cast("double") - F.lit(means[c]))).alias("contribution"))
               for c, w in coefs.items()]
    return x.select(key, F.inline(F.array(*structs)))


def sampled_shapley(model, rows: DataFrame, names, key: str, baseline: dict, n_perm: int = 8,
                    seed: int = 42) -> DataFrame:
    """M12 (any model): sampled-permutation Shapley values of ``rows``.

    For every row and permutation, features are switched from the baseline to the
    row's value one at a time in permutation order; the model scores every
    intermediate vector (one ``transform`` over the exploded table) and the change
    in probability is credited to the switched feature.  Output: (key, feature, phi)
    averaged over permutations.  Permutation orders are md5 ranks, so they are
    deterministic.  What is shuffled is the rows and their values, not the vectors.
    """
    d, spark = len(names), rows.sparkSession
    x = rows.select(key, *[F.col(n).cast("double").alias(f"__x{i}") for i, n in enumerate(names)])
    x = x.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))  # a row becomes n_perm * (d + 1)
    # rank of each feature inside permutation p: order of md5(seed:p:i); one row per permutation
    keyed = F.array(*[md5_order_key(seed, F.concat(F.col("id").cast("string"), F.lit(f":{i}"))) for i in range(d)])
    orders = [r[0] for r in spark.range(n_perm).orderBy("id").select(keyed).collect()]
    ranks = [[sum(o < h for o in order) for h in order] for order in orders]
    plan = F.array(*[F.struct(*[F.lit(r).alias(f"r{i}") for i, r in enumerate(rank)],
                              F.array(*[F.lit(rank.index(j)) for j in range(d)]).alias("switched")) for rank in ranks])
    steps = x.select("*", F.explode(plan).alias("__p")).select("*", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("__j"))
    mixed = F.array(*[F.when(F.col(f"__p.r{i}") < F.col("__j"), F.col(f"__x{i}")).otherwise(F.lit(float(baseline[n])))
                      for i, n in enumerate(names)])
    scored = model.transform(steps.select(key, F.col("__p.switched").alias("__switched"), "__j", array_to_vector(mixed).alias("features")))
    p = vector_to_array(F.col("probability"))[1]
    # whole multiples of 2^-53 add up exactly, in any order
    units = scored.select(key, "__switched", "__j", F.round(p * F.lit(2.0**53)).cast("long").alias("__u"))
    # a score is added to the feature switched last and taken from the one switched next: a row's
    # terms meet in its own task, before the shuffle
    term = lambda j, sign: F.struct(F.get("__switched", j).alias("__f"), (F.col("__u") * sign).alias("__u"), F.lit(max(sign, 0)).alias("__n"))
    sums = units.select(key, F.inline(F.array(term(F.col("__j") - 1, 1), term(F.col("__j"), -1)))).where(
        F.col("__f").isNotNull()).groupBy(key, "__f").agg(F.sum("__u").alias("__u"), F.sum("__n").alias("__n"))
    # rows that repeat a key (__n / n_perm of them) share its value
    phi = F.col("__u") / F.lit(2.0**53) / F.col("__n") / (F.col("__n") / F.lit(n_perm))
    return sums.select(key, F.element_at(F.array(*[F.lit(n) for n in names]), F.col("__f") + 1).alias("feature"), phi.alias("phi"))
