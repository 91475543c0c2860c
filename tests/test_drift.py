import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.operators import drift as D
from tollgate.operators import metrics as M


def scores(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    month = rng.integers(0, 6, n)
    s = np.clip(rng.beta(2, 3 - month / 4), 0, 1).round(2)
    s[:n // 3] = 0.5  # a hot score, on an edge
    return spark.createDataFrame([(int(m), float(v)) for m, v in zip(month, s)], "month int, score double")


def psi_of(df, a, b):
    return M.psi(df.where(a), df.where(b)).agg(F.sum("psi")).first()[0]


def test_exact_below_k_rows_and_merge_order_does_not_matter(spark):
    df = scores(spark, 900)
    months = D.period_sketches(df, F.col("month"))
    halves = D.merged(months, (F.col("period") / 3).cast("int"))
    other = D.merged(D.merged(months.orderBy(F.desc("period")), F.floor(F.col("period") / 1.5)), F.floor(F.col("period") / 2).cast("int"))
    want = psi_of(df, "month < 3", "month >= 3")
    for s in (halves, other):
        got = {r["period"]: (r["n"], r["psi"]) for r in D.sketch_psi(s, 0).collect()}
        assert got[0][1] == 0 and got[1][1] == pytest.approx(want, abs=1e-9) and got[0][0] + got[1][0] == 900


def test_shares_within_the_stated_error_on_many_rows(spark):
    df = scores(spark, 60_000).repartition(5)
    got = D.bin_shares(D.period_sketches(df, F.lit(0), k=256)).collect()
    values = np.array([r["score"] for r in df.select("score").collect()])
    want = np.bincount(np.minimum(np.floor(values * 10), 9).astype(int), minlength=10) / len(values)
    assert len(got) == 10 and max(abs(r["share"] - want[r["bin"]]) for r in got) <= 2 * D.rank_error(256)


def test_edge_cases(spark):
    df = spark.createDataFrame([(None, 0.2), (1, None), (1, float("nan")), (2, 0.7)], "month int, score double")
    s = D.period_sketches(df, F.col("month"))
    assert sorted((str(r["period"]), r["n"]) for r in s.collect()) == [("2", 1), ("None", 1)]
    with pytest.raises(ValueError, match="no period"):
        D.sketch_psi(s, 1)
    assert D.bin_shares(D.period_sketches(df.where("1 = 0"), F.col("month"))).count() == 0
