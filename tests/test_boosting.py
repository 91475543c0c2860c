import numpy as np
import pytest

from tollgate.operators import boosting as BO
from tollgate.operators import models as MD

NAMES = ["a", "b", "c", "d"]


def table(spark, n=400, seed=3, partitions=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 3] = rng.integers(0, 3, n)
    y = (x[:, 0] + 0.5 * x[:, 1] * (x[:, 3] > 0) + rng.normal(size=n) * 0.5 > 0).astype(int)
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label int").repartition(partitions), x, y


def plain(x, y, digest, cuts, rounds, depth, rate, rows, columns, seed, lam=1.0, least=1.0):
    """Every split of every tree tried one after the other, in plain float sums."""
    margin, trees = np.zeros(len(x)), []
    for t in range(rounds):
        cols = sorted(np.random.default_rng([seed, t]).permutation(x.shape[1])[:max(1, round(columns * x.shape[1]))])
        p = 1 / (1 + np.exp(-margin))
        g, h, seen = p - y, p * (1 - p), BO.drawn(digest, seed, t, rows)

        def grow(inside, level):
            G, H = g[inside & seen].sum(), h[inside & seen].sum()
            best = None
            for f in cols if level < depth else []:
                for c in cuts[f]:
                    l = inside & seen & (x[:, f] <= c)
                    r = inside & seen & (x[:, f] > c)
                    if not l.any() or not r.any() or h[l].sum() < least or h[r].sum() < least:
                        continue
                    gain = g[l].sum()**2 / (h[l].sum() + lam) + g[r].sum()**2 / (h[r].sum() + lam) - G**2 / (H + lam)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, c
            if best is None:
                margin[inside] += -rate * G / (H + lam)
                return ("leaf", round(-rate * G / (H + lam), 4))
            _, f, c = best
            return (int(f), float(c), grow(inside & (x[:, f] <= c), level + 1), grow(inside & (x[:, f] > c), level + 1))

        trees.append(grow(np.ones(len(x), bool), 0))
    return trees, margin


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return ("leaf", round(tree.value[node], 4))
    return (tree.feature[node], tree.at[node], nested(tree, tree.left[node]), nested(tree, tree.left[node] + 1))


@pytest.mark.parametrize("rows,columns", [(1.0, 1.0), (0.8, 0.5)])
def test_equals_plain_boosting_split_by_split(spark, rows, columns):
    from pyspark.sql import functions as F
    df, x, y = table(spark)
    model = BO.fit_boosted(df, NAMES, "label", key="id", rounds=3, depth=3, rate=0.3, rows=rows, columns=columns, bins=16)
    digest = np.array([r[0] for r in df.orderBy("id").select(F.xxhash64("id")).collect()], np.int64)
    trees, margin = plain(x, y, digest, model.cuts, 3, 3, 0.3, rows, columns, 42)
    assert [nested(t) for t in model.trees] == trees
    assert np.allclose(model.margin(x), margin, atol=1e-5)
    assert len({len(t.feature) for t in model.trees} - {1}) > 0


def test_partitioning_and_refresh_do_not_change_trees(spark, monkeypatch):
    df, x, _ = table(spark, n=200)
    args = dict(key="id", rounds=3, depth=2, bins=8)
    one = BO.fit_boosted(df.repartition(1), NAMES, "label", **args)
    monkeypatch.setattr(BO, "REFRESH", 1)
    many = BO.fit_boosted(df.repartition(7), NAMES, "label", **args)
    assert [nested(t) for t in one.trees] == [nested(t) for t in many.trees]


def test_learns_and_serves_the_other_operators(spark):
    df, x, y = table(spark, n=600)
    model = BO.fit_boosted(df, NAMES, "label", key="id", rounds=12, depth=3, rate=0.3, bins=32)
    s = {r["id"]: r["score"] for r in MD.score(model, df, NAMES).select("id", "score").collect()}
    score = np.array([s[i] for i in range(600)])
    noiseless = x[:, 0] + 0.5 * x[:, 1] * (x[:, 3] > 0) > 0  # the rule behind the labels, right but for their noise
    assert ((score > 0.5) == y).mean() > (noiseless == y).mean() - 0.03
    assert np.allclose(score, 1 / (1 + np.exp(-model.margin(x))))
    _, _, aucs = MD.cv_auc(df, NAMES, "label", "id", "boosted", k=2, rounds=2, depth=2, bins=8)
    assert len(aucs) == 2 and min(aucs) > 0.75


def test_edge_cases(spark):
    df, _, _ = table(spark, n=60)
    with pytest.raises(ValueError, match="no rows"):
        BO.fit_boosted(df.where("id < 0"), NAMES, "label")
    with pytest.raises(ValueError, match="1 rows miss"):
        BO.fit_boosted(df.selectExpr("id", "IF(id = 3, NULL, a) AS a", "b", "c", "d", "label"), NAMES, "label")
    # equal rows only: nothing to split, the leaf takes the share of ones towards the label
    same = spark.createDataFrame([(1.0, 1)] * 5, "a double, label int")
    model = BO.fit_boosted(same, ["a"], "label", rounds=1, rows=1.0)
    assert model.trees[0].feature == [-1] and model.trees[0].value[0] == pytest.approx(0.1 * 2.5 / (1.25 + 1))
    # one class, a constant feature beside a varying one
    one = spark.createDataFrame([(float(i), 1.0, 0) for i in range(20)], "a double, b double, label int")
    assert BO.fit_boosted(one, ["a", "b"], "label", rounds=1, rows=1.0).margin(np.array([[3.0, 1.0]]))[0] < 0
