"""Hard negatives against plain sorting of all scores."""

import math
import random

import numpy as np
import pytest
from llm_helpers import put
from pyspark.sql import functions as F
from tollgate.llm import op11_negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, scale=256, every=100, positives=5, negatives=10):
    use = set()
    for i, e, label in rows:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        use.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(scale * float(np.float32(x))) for x in e)))
    out = []
    for i, label, v in use:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, x) for j, x, w in use if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            near = [(-n, k) for n, k, x in scored if x != label and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(i, j, r + 1, k, -p, n) for r, (n, k) in enumerate(near[:negatives])]
    return sorted(out)


def vectors(n, d, seed=0, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, d))
    of = rng.integers(0, labels, n)
    return [(i, (centre[of[i]] * 0.1 + rng.normal(size=d) * 0.15).astype(np.float32).tolist(), int(of[i])) for i in range(n)]


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "'x' AS ids", "2 AS v")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = N.hard_negatives(spark, N.labelled_vectors(df, 256, moved), F.col("id") % 100 == 0, **options)
    return sorted(tuple(r) for r in out.collect())


def test_against_brute_force(spark, monkeypatch):
    """Several blocks; ties, repeated rows, hot vectors shared by many rows, odd lengths, unusable rows."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 97)
    rows = vectors(700, 20)
    hot = rows[100][1]
    rows += [(1000 + i, hot, i % 3) for i in range(250)]
    rows += [(3000 + 50 * i, [0.1 * i] * 5, i % 2) for i in range(12)]
    rows += rows[:50] + [(None, hot, 1), (5000, None, 1), (5100, hot, None), (5200, [float("nan")] * 20, 0), (5300, [float("inf")] * 20, 0),
                         (5400, [None] * 20, 0), (5500, [], 1), (5501, [], 2), (5502, [0.0] * 20, 0), (5600, [0.0] * 20, 1)]
    want = brute(rows)
    assert got(spark, rows) == want and len(want) > 200


def test_large_components_stay_exact(spark):
    rows = [(i, [(i % 13 - 6) * 1e6, 3e6 + i, float(i % 5)], i % 2) for i in range(0, 400, 4)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_bounds_prune_and_keep_the_answer(seed, monkeypatch):
    """The bitmap shrinks before the last dimension, and nothing is lost."""
    r = random.Random(seed)
    rng = np.random.default_rng(seed)
    columns = (rng.normal(size=(64, 500)) * np.linspace(40, 1, 64)[:, None]).astype(np.int64)
    labels = rng.integers(0, 2, 500)
    q = columns[:, r.randrange(500)]
    block = N.Block(columns, labels, [[i] for i in range(500)], float(np.abs(q).max()))
    exact = q @ columns
    seen = []
    monkeypatch.setattr(N, "_kth", lambda values, k, f=N._kth: (seen.append(len(values)), f(values, k))[1])
    want = sorted((-int(s), i) for i, s in enumerate(exact) if labels[i] == 1)[:6]
    assert N.positives_of(block, q, 1, 6) == [(i, -s) for s, i in want]
    assert seen[-2] < seen[0] / 4
    p = [-s for s, _ in want]
    near = {x: sorted((-int(s), i) for i, s in enumerate(exact) if labels[i] == 0 and 30 * x <= 100 * s <= 90 * x)[:10] for x in p}
    assert N.negatives_of(block, q, 1, p, (30, 90), 10) == [(x, i, -s) for x in p for s, i in near[x]]


def test_empty_table(spark, tmp_path):
    put(spark.createDataFrame([], SCHEMA), tmp_path, "embeddings")
    df = N.op11_hard_negatives(spark, str(tmp_path))
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and df.count() == 0
