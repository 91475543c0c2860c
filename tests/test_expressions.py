import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollgate.functions import expressions as X


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_floor_days_floors_not_truncates(spark):
    a = dt.datetime(2020, 1, 10, 1, 0)
    rows = [(a, dt.datetime(2020, 1, 9, 3, 0)),      # -22 h -> -1
            (dt.datetime(2020, 1, 9, 23, 0), dt.datetime(2020, 1, 10, 1, 0)),  # +2 h over midnight -> 0
            (a, a + dt.timedelta(days=3, hours=23)),  # 3 d 23 h -> 3
            (a, None)]
    got = one(spark, X.floor_days(F.col("b"), F.col("a")), rows, "a timestamp, b timestamp")
    assert got == [-1, 0, 3, None]


def test_python_title(spark):
    rows = [("  jammu-kashmir ",), ("o'neil",), ("UTTAR PRADESH",), (None,), ("1st road",)]
    got = one(spark, X.python_title(F.col("s")), rows, "s string")
    assert got == ["Jammu-Kashmir", "O'Neil", "Uttar Pradesh", None, "1St Road"]
    assert got[:3] == [r[0].strip().title() for r in rows[:3]]


def test_parse_dmy(spark):
    rows = [("05-01-2020",), ("5-1-2020",), ("31-02-2020",), ("2020-01-05",), ("",), (None,)]
    got = one(spark, X.parse_dmy(F.col("s")), rows, "s string")
    assert got[0] == got[1] == dt.datetime(2020, 1, 5)
    assert got[2:] == [None, None, None, None]


def test_threshold_category(spark):
    rows = [(500000,), (500001,), (None,)]
    got = one(spark, X.threshold_category(F.col("p"), 500000, "Urban", "Rural"), rows, "p long")
    assert got == ["Rural", "Urban", "Rural"]


@pytest.mark.parametrize("fa,na,fb,nb,chi2,p", [
    (79623, 96754, 78831, 96135, 2.8213825, 0.0930163),    # gender golden (A6)
    (91377, 111369, 67077, 81520, 1.7416160, 0.1869342),   # urban-rural golden (A6)
])
def test_yates_chi_square_goldens(spark, fa, na, fb, nb, chi2, p):
    df = spark.createDataFrame([(fa, na - fa, fb, nb - fb)], "a long, b long, c long, d long")
    r = df.select(X.yates_chi2("a", "b", "c", "d").alias("s")).select(
        "s", X.chi2_sf_1dof(F.col("s")).alias("p")).first()
    assert r["s"] == pytest.approx(chi2, abs=1e-6)
    assert r["p"] == pytest.approx(p, abs=2e-7)


def test_weekday_monday_zero(spark):
    rows = [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),)]  # Monday, Sunday
    assert one(spark, X.weekday_monday0(F.col("t")), rows, "t timestamp") == [0, 6]


def test_chi_square_tail_against_erfc(spark):
    import math
    xs = [0.0, 1e-12, 1e-6, 0.01, 0.5, 1.0, 2.8213825, 3.841458820694124, 6.634896601021213, 7.999999, 8.0, 8.000001, 10.827566170662733,
          25.0, 60.0, 300.0, 1200.0]
    rows = [(x,) for x in xs] + [(None,)]
    got = one(spark, X.chi2_sf_1dof(F.col("x")), rows, "x double")
    assert got[-1] is None
    for x, g in zip(xs, got):
        assert g == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-11)
