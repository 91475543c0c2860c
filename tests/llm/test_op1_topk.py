"""Exact top-k against brute force."""

import math
import random

import pytest
from llm_helpers import put
from pyspark.sql import functions as F
from tollgate.llm import op1_topk as K


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, every=100, k=10):
    vec = sorted({(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and usable(v)})
    out = []
    for i, q in vec:
        if i % every == 0:
            s = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, c)))), j) for j, c in vec if j != i and len(c) == len(q))[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def frame(spark, rows, kind="array<double>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}").withColumn("block", F.lit("x")).withColumn("d", F.lit(1))


@pytest.mark.parametrize("lists,qrows,crows", [(4, 256, 4096), (3, 7, 16), (1, 2, 5)])
def test_matches_brute_force(spark, tmp_path, monkeypatch, lists, qrows, crows):
    monkeypatch.setattr(K, "LISTS", lists)
    monkeypatch.setattr(K, "QUERY_ROWS", qrows)
    monkeypatch.setattr(K, "CANDIDATE_ROWS", crows)
    rng = random.Random(8)
    rows = [(i * 25, [rng.gauss(0, 0.2) for _ in range(9)]) for i in range(150)]
    hot = [0.1 * j for j in range(9)]
    rows += [(10_000 + i, hot) for i in range(150)]          # a vector that a third of all rows share
    rows += [(20_000, [0.0] * 9), (20_100, [-0.5] * 9), (20_101, [-0.5] * 9), (20_101, [-0.5] * 9)]
    rows += [(30_000, None), (30_001, [0.1, None] * 4), (30_100, [float("nan")] * 9), (30_200, [float("inf")] * 9), (None, hot)]
    rows += [(40_000, [1.0, 2.0]), (40_001, [1.0, 2.0]), (50_000, []), (50_001, [])]
    got = K.op1_topk_search(spark, put(frame(spark, rows), tmp_path, "embeddings"))
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_scores_beyond_doubles(spark):
    rows = [(0, [1e6, 3e6 + 1]), (1, [1e6, 3e6]), (2, [-7e6, 9e6]), (100, [5e5, 5e5])]
    for times in (1, 64):  # beyond the range of a long, too
        some = [(i, [x * times for x in v]) for i, v in rows]
        big = K.top_k(spark, K.integer_vectors(frame(spark, some)), F.col("id") % 100 == 0)
        assert sorted(map(tuple, big.collect())) == brute(some)


def test_empty_and_single(spark):
    for rows in ([], [(0, [1.0])]):
        assert K.top_k(spark, K.integer_vectors(frame(spark, rows)), F.col("id") % 100 == 0).count() == 0
