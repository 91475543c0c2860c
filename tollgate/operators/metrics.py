"""Evaluation metrics as aggregates over (label, score, prediction).

Threshold metrics are one conditional aggregate.  Ranking metrics first reduce rows to
one row per distinct score (partial aggregate -- a hot score costs one row), then take
exact running sums with ``running_sums`` (no single-task global window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import safe_div
from ..functions.ordered import running_sums
from ..session import checkpoint_dir


def _z(c: Column) -> Column:
    """zero_division=0."""
    return F.coalesce(c, F.lit(0.0))


def predictions(df: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Prediction, class name and risk band from a probability."""
    p = F.col(score)
    return df.withColumn("prediction", (p >= F.lit(threshold)).cast("int")).withColumn(
        "predicted_class", F.when(p >= F.lit(threshold), F.lit("failure")).otherwise(F.lit("success"))
    ).withColumn("risk_level", risk_band(p))


def risk_band(p: Column, high: float = 0.7, medium: float = 0.5) -> Column:
    """R3: 'high' >= 0.7, 'medium' >= 0.5, else 'low'."""
    return (F.when(p >= F.lit(high), F.lit("high")).when(p >= F.lit(medium), F.lit("medium"))
            .otherwise(F.lit("low")))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> list:
    y, p = F.col(label), F.col(pred)
    return [F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
            F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
            F.count(F.when((y == 0) & (p == 0), 1)).alias("tn"),
            F.count(F.when((y == 1) & (p == 0), 1)).alias("fn")]


def _rates(tp, fp, tn, fn):
    prec = _z(safe_div(tp, tp + fp))
    rec = _z(safe_div(tp, tp + fn))
    f1 = _z(safe_div(F.lit(2.0) * prec * rec, prec + rec))
    acc = _z(safe_div(tp + tn, tp + fp + tn + fn))
    return acc, prec, rec, f1


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                   score: str = "score") -> DataFrame:
    """Accuracy, precision, recall, F1 (zero_division 0), Brier score."""
    y = F.col(label).cast("double")
    g = df.agg(*confusion_counts(df, label, pred),
               F.avg(F.pow(F.col(score).cast("double") - y, 2)).alias("brier"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    acc, prec, rec, f1 = _rates(tp, fp, tn, fn)
    return g.select(acc.alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
                    f1.alias("f1"), "brier", "tp", "fp", "tn", "fn")


EVALUATION = "model string, accuracy double, precision double, recall double, f1 double, roc_auc double, brier double, n long"


def evaluation(scored: DataFrame, models) -> DataFrame:
    """One row per model of a long (model, label, score) table: threshold metrics at 0.5, AUC,
    Brier score and rows."""
    rows = []
    for name in models:
        s = predictions(scored.where(F.col("model") == name))
        b, r = binary_metrics(s).first(), ranking_metrics(s).first()
        rows.append((name, b["accuracy"], b["precision"], b["recall"], b["f1"], r["roc_auc"], b["brier"],
                     b["tp"] + b["fp"] + b["tn"] + b["fn"]))
    return scored.sparkSession.createDataFrame(rows, EVALUATION)


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """E5: the four cells [[tn, fp], [fn, tp]] as rows (actual, predicted, n); empty
    cells are present with n = 0."""
    g = df.agg(*confusion_counts(df, label, pred))
    cells = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
             for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))]
    return g.select(F.inline(F.array(*cells)))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted averages."""
    g = df.agg(*confusion_counts(df, label, pred))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    _, p1, r1, f1 = _rates(tp, fp, tn, fn)
    _, p0, r0, f0 = _rates(tn, fn, tp, fp)
    s1, s0 = tp + fn, tn + fp
    tot = (s1 + s0).cast("double")
    rows = [
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"),
                 s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"),
                 s1.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1"), (s0 + s1).alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _z(safe_div(p0 * s0 + p1 * s1, tot)).alias("precision"),
                 _z(safe_div(r0 * s0 + r1 * s1, tot)).alias("recall"),
                 _z(safe_div(f0 * s0 + f1 * s1, tot)).alias("f1"), (s0 + s1).alias("support")),
    ]
    return g.select(F.inline(F.array(*rows)))


def score_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score (descending) with pos/neg counts and the
    cumulative tp/fp at that threshold, plus the class totals.  Rows without a score or a
    label have no place on a curve: they raise, with their number."""
    y = F.col(label).cast("long")
    g = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"), F.count(F.lit(1)).alias("__all"), F.count(y).alias("__labelled"))
    # read three times below (bucket bounds, totals, running sums): write the per-score
    # table once instead of re-running the upstream plan for each pass
    checkpoint_dir(df.sparkSession)
    g = g.withColumn("__neg_t", -F.col("threshold")).checkpoint(eager=True)
    unplaced = g.agg(F.sum(F.when(F.col("threshold").isNull(), F.col("__all")).otherwise(
        F.col("__all") - F.col("__labelled")))).first()[0]
    if unplaced:
        raise ValueError(f"{unplaced} rows have no score or no label")
    g = g.drop("__all", "__labelled")
    c = running_sums(g, ["__neg_t"], ["pos", "neg"]).drop("__neg_t")
    tot = g.agg(F.sum("pos").alias("npos"), F.sum("neg").alias("nneg"))
    return _attach_totals(c, tot)


def _attach_totals(c: DataFrame, tot: DataFrame) -> DataFrame:
    """Totals are one aggregated row: read it and attach the values as literals."""
    r = tot.first()
    return c.withColumn("npos", F.lit(r["npos"] or 0).cast("long")).withColumn(
        "nneg", F.lit(r["nneg"] or 0).cast("long"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               drop_intermediate: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score.

    ``drop_intermediate=True`` gives scikit-learn's curve: a leading (0, 0) point with
    threshold +inf, then only points where the cumulative tp or fp counts change
    slope (second difference non-zero), first and last kept.  Neighbours come from an
    equi-join on the point's rank (itself a distributed running count), not a global
    window.
    """
    c = score_curve(df, label, score)
    if drop_intermediate:
        r = running_sums(c.withColumn("__nt", -F.col("threshold")).withColumn("__one", F.lit(1)),
                         ["__nt"], ["__one"]).withColumnRenamed("cum___one", "__rank")
        pts = r.select("__rank", "threshold", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                       "npos", "nneg")
        prev = pts.select((F.col("__rank") + 1).alias("__rank"), F.col("tp").alias("tp_p"), F.col("fp").alias("fp_p"))
        nxt = pts.select((F.col("__rank") - 1).alias("__rank"), F.col("tp").alias("tp_n"), F.col("fp").alias("fp_n"))
        j = pts.join(prev, "__rank", "left").join(nxt, "__rank", "left")
        keep = (F.col("tp_p").isNull() | F.col("tp_n").isNull()
                | ((F.col("tp_n") - 2 * F.col("tp") + F.col("tp_p")) != 0)
                | ((F.col("fp_n") - 2 * F.col("fp") + F.col("fp_p")) != 0))
        kept = j.where(keep).select("threshold", F.col("tp").alias("cum_pos"), F.col("fp").alias("cum_neg"),
                                    "npos", "nneg")
        start = pts.where(F.col("__rank") == 1).select(
            F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("cum_pos"),
            F.lit(0).cast("long").alias("cum_neg"), "npos", "nneg")
        c = kept.unionByName(start)
    return c.select("threshold", _z(safe_div(F.col("cum_neg"), F.col("nneg"))).alias("fpr"),
                    _z(safe_div(F.col("cum_pos"), F.col("npos"))).alias("tpr"))


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the closing
    (precision 1, recall 0) point without threshold."""
    c = score_curve(df, label, score)
    pts = c.select("threshold", safe_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                   _z(safe_div(F.col("cum_pos"), F.col("npos"))).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def ranking_metrics(df: DataFrame, label: str = "label", score: str = "score",
                    min_precision: float = 0.8) -> DataFrame:
    """Exact ROC AUC with ties counted half (0.5 when one class is
    absent), average precision (step sum), best recall with precision >= min_precision
    (0 when only the closing point qualifies)."""
    c = score_curve(df, label, score)
    prec = safe_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    rec = safe_div(F.col("cum_pos"), F.col("npos"))
    g = c.agg(
        F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))).alias("auc_num"),
        F.sum(F.col("pos") * prec).alias("ap_num"),
        F.max(F.when(prec >= F.lit(min_precision), rec)).alias("r_at_p"),
        F.first("npos").alias("npos"), F.first("nneg").alias("nneg"))
    auc = F.when((F.col("npos") > 0) & (F.col("nneg") > 0),
                 F.col("auc_num") / (F.col("npos").cast("double") * F.col("nneg").cast("double"))).otherwise(0.5)
    return g.select(auc.alias("roc_auc"), _z(safe_div(F.col("ap_num"), F.col("npos"))).alias("average_precision"),
                    _z(F.col("r_at_p")).alias("recall_at_precision"), "npos", "nneg")


def calibration_curve(df: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """Per probability bin the mean score, observed rate and count."""
    b = F.least(F.floor(F.col(score) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.avg(F.col(score).cast("double")).alias("mean_score"),
                                          F.avg(F.col(label).cast("double")).alias("observed_rate"),
                                          F.count(F.lit(1)).alias("n"))


def topk_recall(df: DataFrame, key: str | None = None, label: str = "label", score: str = "score",
                pcts=(1, 5, 10, 20)) -> DataFrame:
    """Share of all positives found in the top k% by score, for several k.

    The top k% is every row scoring at least the score of the ceil(k% x N)-th ranked
    row (ties kept together), so only per-score counts and their running sums are
    needed: a score shared by a third of the rows is one row here.  ``key`` is
    accepted for API symmetry and not needed.
    """
    c = score_curve(df, label, score)
    n_all = F.col("npos") + F.col("nneg")
    c = c.withColumn("__cum_n", F.col("cum_pos") + F.col("cum_neg"))
    aggs = []
    for k in pcts:
        cut = F.floor((n_all * F.lit(k) + F.lit(99)) / F.lit(100))
        aggs.append(F.min_by(F.col("cum_pos"), F.when(F.col("__cum_n") >= cut, F.col("__cum_n")))
                    .alias(f"hit_{k}"))
    g = c.agg(*aggs, F.first("npos").alias("npos"))
    rows = [F.struct(F.lit(k).alias("top_pct"), _z(safe_div(F.col(f"hit_{k}"), F.col("npos"))).alias("recall"))
            for k in pcts]
    return g.select(F.inline(F.array(*rows)))


def psi(expected: DataFrame, actual: DataFrame, score: str = "score", bins: int = 10,
        eps: float = 1e-4) -> DataFrame:
    """Population stability index between two score samples, per bin and total
    (bin shares floored at ``eps``); bins joined with a full outer join."""
    b = F.greatest(F.least(F.floor(F.col(score) * F.lit(bins)), F.lit(bins - 1)), F.lit(0)).cast("int")
    e = expected.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_expected"))
    a = actual.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_actual"))
    j = e.join(a, "bin", "full_outer").na.fill(0, ["n_expected", "n_actual"])
    from pyspark.sql import Window
    w = Window.partitionBy()  # over at most `bins` rows
    pe = F.greatest(F.col("n_expected") / F.sum("n_expected").over(w), F.lit(eps))
    pa = F.greatest(F.col("n_actual") / F.sum("n_actual").over(w), F.lit(eps))
    per = j.select("bin", "n_expected", "n_actual", pe.alias("p_expected"), pa.alias("p_actual"))
    per = per.withColumn("psi", (F.col("p_actual") - F.col("p_expected")) * F.log(F.col("p_actual") / F.col("p_expected")))
    return per


def fairness_by_cohort(df: DataFrame, cohorts, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, TPR, FPR and precision per value of each cohort column, in one
    GROUPING SETS pass; long form (cohort_type, cohort_value, ...)."""
    cohorts = list(cohorts)
    g = df.groupingSets([[F.col(c)] for c in cohorts], *[F.col(c) for c in cohorts]).agg(
        *confusion_counts(df, label, pred), F.grouping_id().alias("gid"))
    nb = len(cohorts)
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(cohorts):
        gid = (1 << nb) - 1 - (1 << (nb - 1 - i))
        name = F.when(F.col("gid") == gid, F.lit(c)).otherwise(name)
        value = F.when(F.col("gid") == gid, F.col(c).cast("string")).otherwise(value)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    acc, prec, rec, _ = _rates(tp, fp, tn, fn)
    return g.select(name.alias("cohort_type"), value.alias("cohort_value"),
                    (tp + fp + tn + fn).alias("n"), acc.alias("accuracy"), rec.alias("tpr"),
                    _z(safe_div(fp, fp + tn)).alias("fpr"), prec.alias("precision")).where(
        F.col("cohort_value").isNotNull())


def model_comparison(df: DataFrame, model: str = "model", label: str = "label", pred: str = "prediction",
                     score: str = "score") -> DataFrame:
    """One row per model with accuracy, Brier and n (a grouped aggregate over the
    union of every model's scored rows)."""
    y = F.col(label)
    return df.groupBy(model).agg(
        _z(safe_div(F.sum(F.when(y == F.col(pred), 1).otherwise(0)), F.count(F.lit(1)))).alias("accuracy"),
        F.avg(F.pow(F.col(score).cast("double") - y.cast("double"), 2)).alias("brier"),
        F.count(F.lit(1)).alias("n"))
