import random

import pytest
from pyspark.sql import functions as F

from tollgate.functions.ordered import exact_quantile, running_sums
from tollgate.operators import metrics as M


def brute_auc_ap(rows):
    pos = sum(y for y, _ in rows)
    neg = len(rows) - pos
    if pos == 0 or neg == 0:
        return 0.5, None
    num = 0.0
    for y, s in rows:
        if y == 1:
            for y2, s2 in rows:
                if y2 == 0:
                    num += 1.0 if s > s2 else 0.5 if s == s2 else 0.0
    auc = num / (pos * neg)
    ap, tp, fp = 0.0, 0, 0
    for t in sorted({s for _, s in rows}, reverse=True):
        p = sum(1 for y, s in rows if s == t and y == 1)
        n = sum(1 for y, s in rows if s == t and y == 0)
        tp, fp = tp + p, fp + n
        ap += (p / pos) * (tp / (tp + fp))
    return auc, ap


def test_running_sums_match_brute_force_with_hot_key(spark):
    rnd = random.Random(1)
    vals = [rnd.randint(0, 50) for _ in range(3000)] + [7] * 1500  # one value holds a third
    df = spark.createDataFrame([(v,) for v in vals], "v long").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    got = {r["v"]: r["cum_n"] for r in running_sums(df, ["v"], ["n"], buckets=16).collect()}
    acc, exp = 0, {}
    for v in sorted(set(vals)):
        acc += vals.count(v)
        exp[v] = acc
    assert got == exp


def test_exact_median_matches_interpolation(spark):
    vals = [1.0, 2.0, 3.0, 4.0] + [10.0] * 3
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert exact_quantile(df, "x", 0.5, buckets=4) == 4.0
    df2 = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert exact_quantile(df2, "x") == 2.5
    assert exact_quantile(df2.where("x is null"), "x") is None


def test_auc_ap_against_brute_force_and_symmetry(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]  # many ties
    df = spark.createDataFrame(rows, "label int, score double")
    r = M.ranking_metrics(df).first()
    auc, ap = brute_auc_ap(rows)
    assert r["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert r["average_precision"] == pytest.approx(ap, abs=1e-12)
    neg = M.ranking_metrics(df.withColumn("score", -F.col("score"))).first()["roc_auc"]
    assert neg == pytest.approx(1 - auc, abs=1e-12)


@pytest.mark.parametrize("rows,auc", [
    ([(1, 0.1), (1, 0.9)], 0.5),                      # one class only
    ([(0, 0.5), (1, 0.5), (0, 0.5)], 0.5),            # all scores equal
    ([(0, 0.1), (1, 0.9), (0, 0.2), (1, 0.8)], 1.0),  # perfect
    ([(1, 0.1), (0, 0.9)], 0.0),                      # inverted
])
def test_auc_edge_cases(spark, rows, auc):
    df = spark.createDataFrame(rows, "label int, score double")
    assert M.ranking_metrics(df).first()["roc_auc"] == auc


def test_threshold_metrics_and_bands(spark):
    rows = [(1, 0.4999), (0, 0.5), (1, 0.6999), (0, 0.7)]
    df = M.predictions(spark.createDataFrame(rows, "label int, score double"))
    bands = [r["risk_level"] for r in df.orderBy("score").collect()]
    assert bands == ["low", "medium", "medium", "high"]
    b = M.binary_metrics(df).first()
    assert (b["tp"], b["fp"], b["tn"], b["fn"]) == (1, 2, 0, 1)
    assert b["precision"] == pytest.approx(1 / 3) and b["recall"] == 0.5
    none_pos = M.predictions(spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, score double"))
    b = M.binary_metrics(none_pos).first()
    assert b["precision"] == 0.0 and b["f1"] == 0.0
    cm = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(none_pos).collect()}
    assert cm == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_recall_at_precision_closing_point(spark):
    # precision never reaches 0.8 except the closing point -> 0
    df = spark.createDataFrame([(0, 0.9), (1, 0.8), (0, 0.7)], "label int, score double")
    assert M.ranking_metrics(df).first()["recall_at_precision"] == 0.0
    pr = M.pr_points(df).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)


def test_topk_recall_hot_score_against_brute_force(spark):
    import math
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 1), 0.5 if i % 3 == 0 else round(rnd.random(), 2)) for i in range(900)]
    df = spark.createDataFrame(rows, "k long, label int, score double")
    got = {r["top_pct"]: r["recall"] for r in M.topk_recall(df, "k", pcts=(1, 10, 50)).collect()}
    srt = sorted((s for _, _, s in rows), reverse=True)
    npos = sum(y for _, y, _ in rows)
    for k in (1, 10, 50):
        cut_score = srt[math.ceil(len(rows) * k / 100) - 1]
        hits = sum(y for _, y, s in rows if s >= cut_score)
        assert got[k] == pytest.approx(hits / npos)


def test_running_sums_two_million_distinct_keys(spark):
    n = 2_000_000
    df = spark.range(n).select((F.col("id") * 7 % n).alias("v"), F.lit(1).alias("one"))  # a permutation
    r = running_sums(df, ["v"], ["one"])
    bad = r.where(F.col("cum_one") != F.col("v") + 1).count()
    assert bad == 0
    assert exact_quantile(df, "v") == (n - 1) / 2


def test_roc_drop_intermediate_matches_sklearn_rule(spark):
    import numpy as np
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = sorted((r["threshold"], round(r["fpr"], 12), round(r["tpr"], 12))
                 for r in M.roc_points(df, drop_intermediate=True).collect())
    # scikit-learn's published rule: distinct thresholds descending, cumulative counts,
    # keep first/last and points where either second difference is non-zero, prepend (0, 0, inf)
    thr = sorted({s for _, s in rows}, reverse=True)
    tps = np.cumsum([sum(1 for y, s in rows if s == t and y == 1) for t in thr])
    fps = np.cumsum([sum(1 for y, s in rows if s == t and y == 0) for t in thr])
    idx = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    P, N = tps[-1], fps[-1]
    exp = sorted([(float("inf"), 0.0, 0.0)] + [(thr[i], round(fps[i] / N, 12), round(tps[i] / P, 12)) for i in idx])
    assert got == exp
