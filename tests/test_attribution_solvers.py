"""Tree attribution against all subsets, isotonic blocks and Newton steps against plain versions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from tollgate.operators import attribution as AT
from tollgate.operators import models as MD
from tollgate.operators import solvers as SO


def subset_value(nodes, x, known, i=0):
    """A tree's mean prediction when only the features in ``known`` are followed."""
    value, rows, left, right, feature, threshold = nodes[i]
    if left < 0:
        return value
    if feature in known:
        return subset_value(nodes, x, known, left if x[feature] <= threshold else right)
    return sum(nodes[c][1] / rows * subset_value(nodes, x, known, c) for c in (left, right))


def brute_shapley(nodes, x, d):
    out = np.zeros(d)
    for i in range(d):
        for k in range(d):
            for s in itertools.combinations([j for j in range(d) if j != i], k):
                weight = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                out[i] += weight * (subset_value(nodes, x, {*s, i}) - subset_value(nodes, x, set(s)))
    return out


def random_tree(rng, d, depth):
    """Full binary tree with random covers; features repeat on a path."""
    nodes = {}

    def grow(i, rows, level):
        if level == depth or rows < 2:
            nodes[i] = (float(rng.normal()), rows, -1, -1, -1, 0.0)
            return
        left = int(rng.integers(1, rows))
        nodes[i] = (0.0, rows, 2 * i + 1, 2 * i + 2, int(rng.integers(d)), float(rng.normal()))
        grow(2 * i + 1, left, level + 1)
        grow(2 * i + 2, rows - left, level + 1)

    grow(0, 200, 0)
    return nodes


@pytest.mark.parametrize("d, depth", [(1, 3), (3, 4), (5, 5), (6, 2), (4, 0)])
def test_attribution_equals_all_subsets(d, depth):
    rng = np.random.default_rng(10 * d + depth)
    trees = [random_tree(rng, d, depth) for _ in range(3)]
    table = AT.table_of([(w, AT.paths_of(t)) for w, t in zip((0.5, 2.0, 1.0), trees)])
    x = rng.normal(size=(6, d))
    want = np.array([sum(w * brute_shapley(t, row, d) for w, t in zip((0.5, 2.0, 1.0), trees)) for row in x])
    got = table.attribution(x, d)
    assert np.allclose(got, want, atol=1e-12)
    assert np.allclose(got.sum(axis=1), table.score(x) - table.expected)
    assert np.isclose(table.expected, sum(w * subset_value(t, None, set()) for w, t in zip((0.5, 2.0, 1.0), trees)))


@pytest.mark.parametrize("d, depth, edges", [(1, 3, 1), (3, 4, 10_000), (5, 6, 20), (4, 0, 1)])
def test_attribution_by_edges_equals_all_subsets(monkeypatch, d, depth, edges):
    monkeypatch.setattr(AT, "EDGES", edges)
    monkeypatch.setattr(AT, "EDGE_CHUNK", 100)
    rng = np.random.default_rng(d + 7 * depth)
    trees = [(w, random_tree(rng, d, depth)) for w in (0.5, 2.0, 1.0)]
    table = AT.table_of([(w, AT.paths_of(t)) for w, t in trees])
    x = rng.normal(size=(6, d))
    by_leaves = table.attribution(x, d)
    table.edges = AT.edge_tables(trees)
    got = table.attribution(x, d)
    want = np.array([sum(w * brute_shapley(t, row, d) for w, t in trees) for row in x])
    assert np.allclose(got, want, atol=1e-12) and np.allclose(got, by_leaves, atol=1e-12)


def test_attribution_takes_products_once_an_edge():
    rng = np.random.default_rng(5)
    tree = random_tree(rng, 6, 7)
    table, (edges,) = AT.table_of([(1.0, AT.paths_of(tree))]), AT.edge_tables([(1.0, tree)])
    assert len(edges.parent) < table.feature.size / 2  # not leaves times path


def frame(spark, n=600):
    return spark.range(n).selectExpr("id AS k", "id % 7 / 3.0 AS x1", "id % 5 / 2.0 - 1 AS x2", "cast(id % 3 as double) AS x3",
                                     "cast(id * 37 % 11 as double) AS x4", "cast((id % 7 + id % 3 > 4) <> (id % 13 = 0) as int) AS y")


@pytest.mark.parametrize("kind, over", [("rf", {"numTrees": 6, "maxDepth": 4}), ("gbt", {"maxIter": 4, "maxDepth": 3})])
def test_attribution_of_fitted_models_adds_up(spark, monkeypatch, kind, over):
    from pyspark.ml.functions import vector_to_array
    names = ["x1", "x2", "x3", "x4"]
    df = frame(spark)
    model = MD.TRAINERS[kind](df, names, "y", **over)
    monkeypatch.setattr(AT, "CHUNK", 5_000)
    table = AT.path_table(spark, model)
    phi = AT.tree_attribution(df, table, names, "k")
    assert phi.columns == ["k", "feature", "phi"] and phi.count() == 600 * 4
    sums = {r.k: r.s for r in phi.groupBy("k").agg(F.sum("phi").alias("s")).collect()}
    out = model.transform(MD.vector_column(df, names))
    out = out.select("k", vector_to_array("probability")[1].alias("s") if kind == "rf" else vector_to_array("rawPrediction")[1].alias("s"))
    assert all(sums[r.k] == pytest.approx(r.s - table.expected, abs=1e-9) for r in out.collect())


def test_attribution_refuses_other_models_and_missing_values(spark):
    df = frame(spark, 60)
    with pytest.raises(TypeError):
        AT.path_table(spark, MD.train_logistic(df, ["x1"], "y"))
    table = AT.path_table(spark, MD.train_random_forest(df, ["x1"], "y", numTrees=2))
    with pytest.raises(Exception, match="impute them first"):
        AT.tree_attribution(spark.createDataFrame([(1, None)], "k long, x1 double"), table, ["x1"], "k").collect()


def plain_isotonic(rows):
    """(score, fitted) by pooling one row at a time."""
    xs = sorted({x for x, _ in rows})
    blocks = []
    for x in xs:
        ys = [y for a, y in rows if a == x]
        blocks.append([[x], sum(ys), len(ys)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + b[0], blocks[-1][1] + b[1], blocks[-1][2] + b[2]]
    return {x: s / n for b, s, n in blocks for x in b}


@pytest.mark.parametrize("case", ["noisy", "hot", "falling", "rising", "one"])
def test_isotonic_equals_the_plain_version(spark, monkeypatch, case):
    monkeypatch.setattr(SO, "MERGE_ROWS", 8)  # several rounds of buckets
    rng = np.random.default_rng(3)
    x = {"noisy": rng.random(900), "hot": np.where(rng.random(900) < 0.5, 0.4, np.round(rng.random(900), 2)),
         "falling": np.arange(200.0), "rising": np.arange(200.0), "one": np.full(30, 0.5)}[case]
    y = {"falling": (np.arange(200) < 100), "rising": (np.arange(200) >= 77)}.get(case, rng.random(len(x)) < x ** 2).astype(int)
    rows = list(zip(x.tolist(), y.tolist()))
    df = spark.createDataFrame(rows, "score double, label int").repartition(5)
    want = plain_isotonic(rows)
    blocks = sorted(SO.isotonic_blocks(df, "score", "label").collect())
    for x_, fitted in want.items():
        assert [b.y / b.w for b in blocks if b.lo <= x_ <= b.hi] == [pytest.approx(fitted)]
    assert all(a.hi < b.lo and a.y / a.w < b.y / b.w for a, b in zip(blocks, blocks[1:]))
    model = SO.fit_isotonic(df, "score", "label")
    library = IsotonicRegression(featuresCol="score", labelCol="l", predictionCol="lib").fit(df.selectExpr("score", "cast(label as double) AS l"))
    grid = spark.createDataFrame([(float(v),) for v in [*want, -1.0, 0.123, 0.777, 300.0]], "score double")
    both = library.transform(model.transform(grid)).collect()
    assert all(r.cal == pytest.approx(r.lib, abs=1e-9) for r in both)


def test_isotonic_refuses_missing_scores(spark):
    with pytest.raises(ValueError):
        SO.isotonic_blocks(spark.createDataFrame([(None, 1), (0.5, 0)], "score double, label int"), "score", "label")


def test_newton_reaches_the_optimum(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) * [1, 5, 0.1]
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [1, -0.4, 2] - 0.7)))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, y int").repartition(4)
    weight = F.when(F.col("y") == 1, 2.0).otherwise(0.5)
    m = SO.fit_newton(df, ["a", "b", "c"], "y", weight)
    w, b = np.where(y == 1, 2.0, 0.5), np.append(m.coefficients, m.intercept)
    one = np.c_[x, np.ones(500)]

    def loss(b):
        z = one @ b
        return w @ (np.logaddexp(0, z) - y * z) + 0.5 * b[:3] @ b[:3]
    gradient = one.T @ (w * (1 / (1 + np.exp(-one @ b)) - y)) + np.append(b[:3], 0)
    assert np.abs(gradient).max() < 1e-5 and np.allclose(gradient, m.gradient, atol=1e-6)
    assert all(loss(b) <= loss(b + rng.normal(size=4) * 1e-3) for _ in range(20))
    p = np.array([r.p for r in df.select("a", "b", "c", m.probability().alias("p")).collect()])
    assert ((p > 0) & (p < 1)).all()


def test_newton_separable_and_refusals(spark):
    """Perfectly separable rows have a finite penalised optimum; one class or missing values raise."""
    df = spark.createDataFrame([(float(i), int(i > 5)) for i in range(12)], "a double, y int")
    m = SO.fit_newton(df, ["a"], "y")
    assert m.coefficients[0] > 0 and np.abs(m.gradient).max() < 1e-6
    with pytest.raises(ValueError, match="one class"):
        SO.fit_newton(df.where("y = 1"), ["a"], "y")
    with pytest.raises(ValueError, match="miss a label"):
        SO.fit_newton(spark.createDataFrame([(None, 1), (1.0, 0)], "a double, y int"), ["a"], "y")
