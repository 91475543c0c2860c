"""M16 over time: one mergeable quantile sketch a period, from which the population stability index
between any two periods follows without reading the scores again.

Sketches are Spark's KLL sketches: partial sketches of tasks are merged by the aggregate, stored
sketches of finer periods by ``merged``.  A share of rows below an edge is off by ``rank_error(k)``
at most with 99% confidence, whatever the rows, and exact for fewer than ``k`` rows.  Rows
without a score (NULL or NaN) are left out; a period is one row, a NULL period too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_error(k: int) -> float:
    """Published 99% error of a KLL sketch's shares between two edges (fixed values)."""
    return 2.446 / k**0.9433


def period_sketches(df: DataFrame, period: Column, score: str = "score", k: int = 4096) -> DataFrame:
    """(period, n, sketch)"""
    s = F.col(score).cast("double")
    return df.where(s.isNotNull() & ~F.isnan(s)).groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(s, k).alias("sketch"))


def merged(sketches: DataFrame, period: Column) -> DataFrame:
    """Sketches of longer periods from those of shorter ones."""
    return sketches.groupBy(period.alias("period")).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def _shares(bins: int) -> list[Column]:
    """Shares of scores in [i / bins, (i + 1) / bins); the outer bins are open."""
    below = [F.kll_sketch_get_rank_double("sketch", F.lit(math.nextafter(i / bins, -math.inf))) for i in range(1, bins)]
    return [b - a for a, b in zip([F.lit(0.0), *below], [*below, F.lit(1.0)])]


def bin_shares(sketches: DataFrame, bins: int = 10) -> DataFrame:
    """(period, n, bin, share) from the sketches alone."""
    return sketches.select("period", "n", F.posexplode(F.array(*_shares(bins))).alias("bin", "share"))


def sketch_psi(sketches: DataFrame, base, bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """(period, n, psi): stability of every period against ``base`` (shares floored at ``eps``)."""
    first = sketches.where(F.col("period").eqNullSafe(F.lit(base))).select(F.array(*_shares(bins)).alias("s")).first()  # one row
    if first is None:
        raise ValueError(f"no period {base!r}")
    psi = F.lit(0.0)
    for e, a in zip(first["s"], _shares(bins)):
        e, a = F.lit(max(e, eps)), F.greatest(a, F.lit(eps))
        psi = psi + (a - e) * F.log(a / e)
    return sketches.select("period", "n", psi.alias("psi"))
