"""Mixing: classifier on held-out labels, rates against a plain projected gradient in numpy."""

import numpy as np
import pytest
from llm_helpers import documents, put
from pyspark.sql import functions as F
from tollgate.llm import op3_mixing as M
from tollgate.llm.common import table

SF = "/root/testdata/sf0.01"


def brute_rates(p, n, goal, iterations, speed=True):
    """Projected gradient of the weighted least squares, all documents in one array."""
    h = (p * n[:, None]).T @ p
    scale = 1 / np.diag(h)
    eta = 1 / np.linalg.eigvalsh(np.sqrt(scale)[:, None] * h * np.sqrt(scale)[None, :])[-1]
    r, y, t = np.ones(len(p)), np.ones(len(p)), 1.0
    for _ in range(iterations):
        off = ((y * n)[:, None] * p).sum(axis=0) - goal
        new, u = np.maximum(0, y - eta * (p * (scale * off)).sum(axis=1)), (1 + np.sqrt(1 + 4 * t * t)) / 2
        r, y, t = new, new + (t - 1) / u * (new - r) * speed, u
    return r


def scored_frame(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.3, 0.3, 0.3], n)
    tokens = rng.integers(1, 500, n)
    return spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p))],
                                 "doc_id long, n_tokens long, p array<double>"), p, tokens.astype(float)


def test_rates_match_brute_force(spark):
    scored, p, n = scored_frame(spark)
    domains, targets = ("a", "b", "c"), {"a": 0.6, "b": 0.3, "c": 0.1}
    steps = M.fit(scored, domains, targets, "a", total=float(n.sum()))
    goal = np.array([0.6, 0.3, 0.1]) * n.sum()
    r = M.rates(p, steps)
    assert np.allclose(r, brute_rates(p, n, goal, len(steps)))
    assert (r >= 0).all() and np.abs((r * n) @ p - goal).max() <= 1e-3 * n.sum()


def test_unreachable_targets_settle(spark):
    scored, p, n = scored_frame(spark, seed=1)
    steps = M.fit(scored, ("a", "b", "c"), {"a": 1.0, "b": 0.0, "c": 0.0}, "a", total=float(n.sum()))
    r = M.rates(p, steps)
    assert (r >= 0).all()
    long = brute_rates(p, n, np.array([1.0, 0, 0]) * n.sum(), 20_000, speed=False)
    goal, h = np.array([1.0, 0, 0]) * n.sum(), (p * n[:, None]).T @ p

    def loss(x):
        return float((((x * n) @ p - goal) ** 2 / np.diag(h)).sum())
    assert loss(r) <= 1.05 * loss(long) + 1e-9


@pytest.mark.parametrize("share", [1.0, 0.9])
def test_unreachable_targets_give_the_least_squares(spark, share):
    scored, p, n = scored_frame(spark, seed=7)
    weights, total = np.array([share, 0.9999 - share if share < 1 else 0.0, 0.0001 if share < 1 else 0.0]), 3 * float(n.sum())
    r = M.rates(p, M.fit(scored, ("a", "b", "c"), dict(zip("abc", weights)), "a", total=total, most=M.MOST), M.MOST)
    goal, h = weights * total, (p * n[:, None]).T @ p
    scale = 1 / np.maximum(goal, 1e-3 * total)
    eta = 1 / np.linalg.eigvalsh(np.sqrt(scale)[:, None] * h * np.sqrt(scale)[None, :])[-1]
    x = np.ones(len(p))
    for _ in range(20_000):
        x = np.clip(x - eta * (p @ (scale * ((x * n) @ p - goal))), 0, M.MOST)

    def loss(x):
        return float((((x * n) @ p - goal) ** 2 * scale).sum())
    assert loss(x) > 1e-3 * loss(np.ones(len(p))) and loss(r) <= 1.05 * loss(x)


def test_unsettled_fit_warns(spark):
    scored, _, n = scored_frame(spark, seed=1)
    with pytest.warns(UserWarning, match="not settled after 3 iterations"):
        assert len(M.fit(scored, ("a", "b", "c"), {"a": 1.0, "b": 0.0, "c": 0.0}, "a", total=float(n.sum()), iterations=3)) == 3


def test_bounded_rates_move_scarce_shares_to_their_targets(spark):
    """Scarce c, and nothing above its target."""
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.5, 0.5, 0.01], 400) * [1, 1, 0.3]
    p /= p.sum(axis=1, keepdims=True)
    n = rng.integers(1, 500, 400).astype(float)
    have = n @ p
    want = np.array([have[0], have[1], 1.5 * have[2]]) / (n.sum() + 0.5 * have[2])
    scored = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    r = M.rates(p, M.fit(scored, ("a", "b", "c"), dict(zip("abc", want)), "a", most=M.MOST), M.MOST)
    got = (r * n) @ p
    assert r.min() >= 0 and 1 < r.max() <= M.MOST
    assert np.abs(got / got.sum() - want).max() <= 1e-3 and abs(got[0] / have[0] - 1) <= 1e-3


def test_bounded_rates_leave_out_domains_without_tokens(spark):
    scored, p, n = scored_frame(spark, seed=4)
    p = np.c_[p[:, :2] / p[:, :2].sum(axis=1, keepdims=True), np.zeros(len(p))]
    scored = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    r = M.rates(p, M.fit(scored, ("a", "b", "c"), {"a": 0.6, "b": 0.2, "c": 0.2}, "a", most=M.MOST), M.MOST)
    got = (r * n) @ p
    assert np.abs(got / got.sum() - [0.75, 0.25, 0]).max() <= 1e-3


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    training = labels.where("doc_id % 3 <> 0")
    c = M.train(docs, training, M.label_domain(), tuple(sorted(M.TARGETS)))
    truth = labels.where("doc_id % 3 = 0").select("doc_id", M.label_domain().alias("domain"))
    rows = M.posteriors(docs, c).join(truth, "doc_id").collect()
    right = sum(c.domains[int(np.argmax(r.p))] == r.domain for r in rows)
    assert len(rows) > 100 and right >= 0.9 * len(rows)


def test_query_meets_targets_and_keeps_good_documents(spark):
    rows = M.op3_mix_sources(spark, SF).join(
        table(spark, SF, "labels").select("doc_id", M.label_domain().alias("true")), "doc_id").collect()
    good = [r for r in rows if r.true == "good"]
    assert np.mean([r.copies >= 1 for r in good]) >= 0.95
    toxic = [r for r in rows if r.true == "toxic"]
    assert np.mean([r.copies for r in toxic]) <= 0.4
    assert all(abs(r.p_good + r.p_poor + r.p_toxic - 1) < 1e-9 and r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)


def reached(rows, domains=("good", "poor", "toxic")):
    """Shares of the expected tokens at the rates."""
    got = np.array([sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in domains])
    return got / got.sum()


def test_query_reaches_the_shares(spark):
    assert np.abs(reached(M.op3_mix_sources(spark, SF).collect()) - [0.97, 0.02, 0.01]).max() <= 1e-3


def test_copies_round_without_bias():
    rate = np.full(20_000, 1.3)
    n = M._copies(rate, list(range(20_000)))
    assert set(n) == {1, 2} and abs(n.mean() - 1.3) < 0.02


def test_rows_that_share_an_id_are_rounded_apart():
    """A third of the rows without id, each with its own text: their copies follow the rate."""
    n = M._copies(np.full(9_000, 0.4), [M.draw(None, b"text %d" % i) for i in range(9_000)])
    assert abs(n.mean() - 0.4) < 0.02 and M.draw(None, b"a") == M.draw(None, b"a") != M.draw(1, b"a")


def test_training_rows_are_bounded(spark):
    """Many rows on one sampled id are one training row."""
    docs = documents(spark, [(1, f"good text {i}") for i in range(300)] + [(2, "poor trash"), (3, "good too")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    c = M.train(docs, labels, M.label_domain(), ("good", "poor"), sample_rows=3)
    one = M.train(docs.where("doc_id > 1 OR text = 'good text 0'"), labels, M.label_domain(), ("good", "poor"), sample_rows=3)
    assert np.allclose(c.biases, one.biases) and np.allclose(c.weights, one.weights)


DOCS = [(1, "good words here"), (2, None), (3, ""), (4, "stupid trash text"), (5, "x " * 50_000), (None, "no id"), (4, "stupid trash text"), (6, "plain")]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 0), (4, 1, 1), (4, 0, 0), (99, 1, 0), (None, 1, 0), (6, None, None)]])
def test_edge_cases(spark, tmp_path, labels):
    docs = documents(spark, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("domain", F.lit("clash"))
    put(docs, tmp_path, "documents"), put(lab, tmp_path, "labels")
    got = M.op3_mix_sources(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((d for d, _ in DOCS), key=repr)
    assert all(r.rate >= 0 and r.n_tokens == len((dict(DOCS)[r.doc_id] or "").split()) for r in got)
    kept = M.mixed(spark, docs, lab)
    assert kept.schema == docs.schema
    copies = {r.doc_id: r.copies for r in got}
    assert all(kept.where(F.col("doc_id").eqNullSafe(d)).count() == copies[d] * sum(x == d for x, _ in DOCS) for d in {d for d, _ in DOCS})


def test_empty_table(spark):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert M.document_rates(spark, documents(spark, []), lab).count() == 0
    assert M.mixed(spark, documents(spark, []), lab).count() == 0
