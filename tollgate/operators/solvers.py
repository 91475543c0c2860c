"""Distributed fits whose driver part does not grow with the rows.

* ``fit_isotonic`` (M6): pool-adjacent-violators in range buckets.  Rows are first summed by score
  (a hot score is one row); each range bucket pools its own violators; the blocks that are left
  are far fewer (of n noisy binary labels about n^(1/3), and never more than distinct increasing
  fractions of n rows, about n^(2/3)) and are pooled again, in order, in ever fewer buckets.
  Pooling is exact in any order.  Only final blocks reach MLlib, whose model serves scoring.
* ``fit_newton`` (M3): weighted L2 logistic regression by Newton steps.  A step is one aggregate:
  every task adds up its rows' loss, gradient and Hessian, and the sums meet by position.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import range_buckets
from ..session import checkpoint_dir

#: Blocks that one task pools in the last merge without another round of buckets.
MERGE_ROWS = 100_000
BLOCKS = "lo double, hi double, w double, y double"


def pool(out: list, blocks) -> list:
    """Pool-adjacent-violators: appends blocks (lo, hi, weight, weighted label sum), in order, to
    blocks of strictly increasing means."""
    for a, b, n, s in blocks:
        while out and out[-1][3] * n >= s * out[-1][2]:
            a, _, m, t = out.pop()
            n, s = n + m, s + t
        out.append((a, b, n, s))
    return out


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pools a whole partition, batch by batch."""
    kept: list = []
    for batch in batches:
        pool(kept, zip(*(c.to_pylist() for c in batch.columns)))
    columns = list(zip(*kept)) if kept else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], names=["lo", "hi", "w", "y"])


def isotonic_blocks(df: DataFrame, score: str, label: str, weight: Column | None = None) -> DataFrame:
    """(lo, hi, w, y): the blocks of the increasing least-squares fit of ``label`` on ``score``,
    checkpointed.  Rows with a NULL or NaN score or a NULL label raise."""
    x, w = F.col(score).cast("double"), weight if weight is not None else F.lit(1.0)
    g = df.select((x + F.lit(0.0)).alias("lo"), F.col(label).cast("double").alias("l"), w.cast("double").alias("w"))  # -0.0 is 0.0
    checkpoint_dir(df.sparkSession)
    g = g.groupBy("lo").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("l")).alias("y"), F.count(F.when(F.col("l").isNull(), 1)).alias("bad"))
    g = g.checkpoint(eager=True)  # one row a score
    n, bad = g.agg(F.count(F.lit(1)), F.count(F.when(F.col("lo").isNull() | F.isnan("lo") | (F.col("bad") > 0), 1))).first()
    if bad:
        raise ValueError("rows without score or label cannot be calibrated")
    g = g.select("lo", F.col("lo").alias("hi"), "w", "y")
    # partitions are ranges of scores from here on
    blocks = g.repartition(1) if n <= MERGE_ROWS else range_buckets(g, ["lo"]).drop("__bucket")
    while True:
        blocks = blocks.sortWithinPartitions("lo").mapInArrow(_pooled, BLOCKS).checkpoint(eager=True)
        parts = blocks.rdd.getNumPartitions()
        if parts == 1:
            return blocks
        before, n = n, blocks.count()
        # fewer, adjacent ranges: coalescing by order keeps them adjacent
        parts = 1 if n <= MERGE_ROWS or n == before else max(1, min(parts // 2, -(-n // MERGE_ROWS)))
        blocks = blocks.repartitionByRange(parts, "lo") if parts > 1 else blocks.repartition(1)


def fit_isotonic(df: DataFrame, score: str, label: str, out: str = "cal", weight: Column | None = None) -> IsotonicRegressionModel:
    """The increasing calibration map; MLlib only sees both ends of each final block."""
    blocks = isotonic_blocks(df, score, label, weight)
    ends = blocks.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias(score), (F.col("y") / F.col("w")).alias("__y"))
    return IsotonicRegression(featuresCol=score, labelCol="__y", predictionCol=out).fit(ends)


@dataclass
class NewtonModel:
    """Coefficients of a fitted logistic regression, its last gradient and its steps."""

    names: list
    coefficients: np.ndarray
    intercept: float
    gradient: np.ndarray  # of the coefficients, then of the intercept
    steps: int

    def probability(self) -> Column:
        z = F.lit(self.intercept)
        for n, c in zip(self.names, self.coefficients.tolist()):
            z = z + F.lit(c) * F.col(n).cast("double")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _sums(data: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted log loss, its gradient and Hessian at ``beta`` (intercept last): one job."""
    d = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + d + d * d)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            z = x @ beta
            p = 0.5 * (1 + np.tanh(z / 2))
            total[0] += w @ (np.logaddexp(0, z) - y * z)
            total[1:1 + d] += x.T @ (w * (p - y))
            total[1 + d:] += (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["at", "s"])

    sums = data.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()  # (d + 1)^2 numbers
    total = np.zeros(1 + d + d * d)
    for r in sums:
        total[r["at"]] = r["s"]
    return float(total[0]), total[1:1 + d], total[1 + d:].reshape(d, d)


def fit_newton(df: DataFrame, names: list, label: str, weight: Column | None = None, penalty: float = 1.0,
               tolerance: float = 1e-8, most: int = 50) -> NewtonModel:
    """Minimises penalty / 2 * |coefficients|^2 + sum of weight * log loss (the intercept is free)
    to a gradient below ``tolerance`` times the total weight.  Steps are halved until the loss
    falls; without convergence after ``most`` steps it raises.  Missing labels or values raise."""
    d = len(names) + 1
    x = F.array(*[F.col(n).cast("double") for n in names], F.lit(1.0))
    w = weight if weight is not None else F.lit(1.0)
    data = df.select(x.alias("x"), F.col(label).cast("double").alias("y"), w.cast("double").alias("w"))
    data = data.checkpoint(eager=True)  # every step reads it
    seen = data.agg(F.sum("w").alias("w"), F.count(F.when(F.exists("x", lambda v: v.isNull() | F.isnan(v)) | F.col("y").isNull(), 1)).alias("bad"),
                    F.count_distinct("y").alias("classes")).first()
    if seen["bad"]:
        raise ValueError(f"{seen['bad']} rows miss a label or a feature value")
    if seen["classes"] < 2:
        raise ValueError("one class only: the intercept has no finite optimum")
    ridge = np.full(d, float(penalty))
    ridge[-1] = 0.0
    beta = np.zeros(d)
    loss, gradient, hessian = _sums(data, beta)
    for step in range(most + 1):
        slope = gradient + ridge * beta
        if np.abs(slope).max() <= tolerance * seen["w"]:
            return NewtonModel(list(names), beta[:-1], float(beta[-1]), slope, step)
        if step == most:
            break
        direction = np.linalg.lstsq(hessian + np.diag(ridge), slope, rcond=None)[0]
        value, size = loss + 0.5 * ridge @ beta**2, 1.0
        while True:
            new = beta - size * direction
            loss, gradient, hessian = _sums(data, new)
            if loss + 0.5 * ridge @ new**2 <= value + 1e-12 * abs(value) or size < 1e-10:
                break
            size /= 2
        beta = new
    raise RuntimeError(f"Newton's method did not reach a gradient of {tolerance} after {most} steps: {np.abs(slope).max()}")
