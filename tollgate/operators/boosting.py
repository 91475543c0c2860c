"""M5: second-order gradient boosting of the logistic loss over quantile-binned histograms.

* Features are cut once at approximate quantiles (one aggregate for all features); rows are kept as
  bin numbers.  A value on a cut belongs to the left.
* A tree grows level by level.  In one job a level, every task sums its rows' gradients and Hessians
  by (node, feature, bin); the sums meet by (node, feature), running sums over the bins give every
  split's gain, and one best split a node and feature returns to the driver.  What moves is bounded by
  tasks x nodes x features x bins, whatever the rows.
* Gradients are summed as whole multiples of 2^-24, so sums are exact: repeated tasks and other
  partitionings give the same trees.  Ties go to the smaller feature number, then to the smaller cut.
* Leaf weights are -G / (H + penalty), times the learning rate.  A split needs a Hessian of
  ``least`` on either side and a gain above ``gain``.
* Each tree sees its own draw of rows (by a hash of the key, or of the row's values without one) and
  of features.
* Margins are written back to the rows every ``REFRESH`` trees, so a job replays at most that many.

Empty tables and missing labels or features raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

SCALE = 2.0**24
#: Trees that a job may replay before margins are written back.
REFRESH = 10
ROWS = "digest long, y double, w double, margin double, x array<smallint>"


@dataclass
class Tree:
    """Arrays over nodes, the root first; a row goes to ``left`` if its value is at most ``at``,
    else to ``left + 1``.  Leaves have feature -1."""

    feature: list = field(default_factory=lambda: [-1])
    at: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at, values) -> tuple[int, int]:
        """Turns a leaf into a split with two new leaves of the given values."""
        first = len(self.feature)
        self.feature[node], self.at[node], self.left[node] = feature, at, first
        for v in values:
            self.feature.append(-1), self.at.append(0), self.left.append(-1), self.value.append(v)
        return first, first + 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        feature, at, left = np.array(self.feature), np.array(self.at), np.array(self.left)
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[feature[node[rows]] >= 0]
            here = node[rows]
            node[rows] = left[here] + (x[rows, feature[here]] > at[here])
        return node

    def values(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(x)]


@dataclass
class BoostedModel:
    """Trees over feature values; ``transform`` adds MLlib's ``probability`` to rows with ``features``."""

    names: list
    trees: list
    cuts: list

    def margin(self, x: np.ndarray) -> np.ndarray:
        return sum((t.values(x) for t in self.trees), np.zeros(len(x)))

    def transform(self, df: DataFrame) -> DataFrame:
        margin = self.margin

        @F.pandas_udf("double")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(_sigmoid(margin(np.stack(x))) if len(x) else [], dtype="float64")

        p = df.withColumn("__p", probability(vector_to_array("features")))
        return p.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("__p"), F.col("__p")))).drop("__p")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def drawn(digest: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: a mixed 64-bit hash of the row's digest below ``share``."""
    if share >= 1:
        return np.ones(len(digest), bool)
    z = digest.astype(np.int64).view(np.uint64) + np.uint64((seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values: 64-bit mixing
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(share * 2.0**64))


def quantile_cuts(df: DataFrame, names: list, bins: int = 256, accuracy: int = 10_000) -> list:
    """At most ``bins - 1`` increasing cuts of each feature, all below its largest value; ranks are
    within rows / ``accuracy``.  A value held by fewer than 1 / ``bins`` of the rows may get none."""
    steps = [i / bins for i in range(1, bins)]
    cols = [F.col(n).cast("double") for n in names]
    got = df.agg(*[F.percentile_approx(c, steps, accuracy).alias(f"q{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return [np.array(sorted({v + 0.0 for v in got[f"q{i}"] or [] if v < got[f"m{i}"]})) for i in range(len(names))]


def _unpack(batch: pa.RecordBatch, features: int) -> tuple:
    digest, y, w, margin = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    return digest, y, w, margin, batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, features)


def _pack(digest, y, w, margin, x) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel().astype(np.int16)))
    return pa.RecordBatch.from_arrays([pa.array(digest, pa.int64()), pa.array(y, pa.float64()), pa.array(w, pa.float64()),
                                       pa.array(margin, pa.float64()), lists], names=["digest", "y", "w", "margin", "x"])


def binned(df: DataFrame, names: list, label: str, cuts: list, key: str | None = None, weight: Column | None = None) -> DataFrame:
    """Rows as bin numbers (how many cuts lie below the value), margin 0, checkpointed."""
    checkpoint_dir(df.sparkSession)
    values = [F.col(n).cast("double") for n in names]
    w = weight if weight is not None else F.lit(1.0)
    raw = df.select(F.xxhash64(*([F.col(key)] if key else [*values, F.col(label)])).alias("digest"),
                    F.col(label).cast("double").alias("y"), w.cast("double").alias("w"), F.lit(0.0).alias("margin"),
                    F.array(*values).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, x = _unpack(batch, len(cuts))
            yield _pack(*rest, np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1))

    return raw.mapInArrow(run, ROWS).checkpoint(eager=True)


def _boosted(data: DataFrame, trees: list, features: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, y, w, margin, x = _unpack(batch, features)
            yield _pack(digest, y, w, margin + sum(t.values(x) for t in trees), x)

    return data.mapInArrow(run, ROWS).checkpoint(eager=True)


def best_splits(data: DataFrame, features: int, pending: list, tree: Tree, nodes: list, columns: list, number: int, bins: int,
                seed: int = 42, share: float = 1.0, penalty: float = 1.0, least: float = 1.0) -> DataFrame:
    """(node, feature, g, h, n, best): totals of every node in ``nodes`` and, by feature, its best split
    (gain, at, gl, hl; NULL if no cut leaves enough on either side).  Gradients are taken after ``pending`` trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = len(nodes) * len(columns) * bins
        total = np.zeros((3, slots), np.int64)
        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))
        for batch in batches:
            digest, y, w, margin, x = _unpack(batch, features)
            at = place[tree.leaves(x)]
            rows = np.flatnonzero((at >= 0) & drawn(digest, seed, number, share))
            if not len(rows):
                continue
            x, y, w = x[rows], y[rows], w[rows]
            p = _sigmoid(margin[rows] + sum(t.values(x) for t in pending))
            where = (at[rows][:, None] * len(columns) + np.arange(len(columns))) * bins + x[:, columns]
            for i, v in enumerate((np.rint(SCALE * w * (p - y)), np.rint(SCALE * w * p * (1 - p)), np.ones(len(rows)))):
                # a batch's sums are whole numbers below 2^53: exact in doubles
                total[i] += np.bincount(where.ravel(), np.repeat(v, len(columns)), slots).astype(np.int64)
        used = np.flatnonzero(total[2])
        node, rest = np.divmod(used, len(columns) * bins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(nodes)[node], pa.int32()), pa.array(np.array(columns)[rest // bins], pa.int32()),
             pa.array(rest % bins, pa.int32()), *(pa.array(t[used], pa.int64()) for t in total)],
            names=["node", "feature", "at", "g", "h", "n"])

    sums = (data.mapInArrow(run, "node int, feature int, at int, g long, h long, n long")
            .repartition("node", "feature")  # tasks send one row a slot: nothing left to combine before
            .groupBy("node", "feature", "at").agg(*[F.sum(c).alias(c) for c in "ghn"]))
    whole = Window.partitionBy("node", "feature")
    before = whole.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.select("node", "feature", "at", *[F.sum(c).over(before).alias(f"{c}l") for c in "ghn"],
                       *[F.sum(c).over(whole).alias(c) for c in "ghn"])
    g, h, gl, hl = ((F.col(c) / F.lit(SCALE)) for c in ("g", "h", "gl", "hl"))
    gr, hr = ((F.col(c) - F.col(f"{c}l")) / F.lit(SCALE) for c in "gh")
    lam = F.lit(float(penalty))
    gain = F.try_divide(gl * gl, hl + lam) + F.try_divide(gr * gr, hr + lam) - F.try_divide(g * g, h + lam)
    fits = (hl >= F.lit(float(least))) & (hr >= F.lit(float(least))) & (F.col("nl") < F.col("n")) & gain.isNotNull()
    split = F.when(fits, F.struct(gain.alias("gain"), (-F.col("at")).alias("minus_at"), gl.alias("gl"), hl.alias("hl")))
    return sums.groupBy("node", "feature").agg(F.max(g).alias("g"), F.max(h).alias("h"), F.max("n").alias("n"), F.max(split).alias("best"))


def fit_boosted(df: DataFrame, names: list, label: str, key: str | None = None, weight: Column | None = None, rounds: int = 100,
                depth: int = 6, rate: float = 0.1, rows: float = 0.8, columns: float = 0.8, bins: int = 256,
                penalty: float = 1.0, least: float = 1.0, gain: float = 1e-6, seed: int = 42) -> BoostedModel:
    """Boosted trees for labels 0 and 1, starting from probability 0.5."""
    names, w = list(names), weight if weight is not None else F.lit(1.0)
    missing = [F.col(n).isNull() | F.isnan(F.col(n).cast("double")) for n in names]
    bad = F.col(label).isNull() | w.isNull()
    for m in missing:
        bad = bad | m
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(bad, 1)).alias("bad"), F.sum(w.cast("double")).alias("w")).first()
    if not seen["n"]:
        raise ValueError("no rows to train on")
    if seen["bad"]:
        raise ValueError(f"{seen['bad']} rows miss a label or a feature value")
    if seen["w"] * SCALE >= 2.0**62:
        raise ValueError("total weight too large for exact sums: scale the weights down")
    cuts = quantile_cuts(df, names, bins)
    data, trees, pending = binned(df, names, label, cuts, key, weight), [], []
    for number in range(rounds):
        some = np.sort(np.random.default_rng([seed, number]).permutation(len(names))[:max(1, round(columns * len(names)))]).tolist()
        tree, nodes = Tree(), [0]
        for level in range(depth):
            found: dict = {}
            for r in best_splits(data, len(names), pending, tree, nodes, some, number, bins, seed, rows, penalty, least).collect():  # nodes x features
                if level == 0:
                    tree.value[0] = -rate * r["g"] / (r["h"] + penalty) if r["h"] + penalty > 0 else 0.0
                if r["best"] and r["best"]["gain"] > gain:
                    choice = (r["best"]["gain"], -r["feature"], r["best"]["minus_at"])
                    if r["node"] not in found or choice > found[r["node"]][0]:
                        found[r["node"]] = choice, r
            nodes = []
            for node, ((_, feature, at), r) in sorted(found.items()):
                gl, hl = r["best"]["gl"], r["best"]["hl"]
                nodes += tree.split(node, -feature, -at, [-rate * gl / (hl + penalty), -rate * (r["g"] - gl) / (r["h"] - hl + penalty)])
            if not nodes:
                break
        trees.append(tree)
        pending.append(tree)
        if len(pending) == REFRESH and number + 1 < rounds:
            data, pending = _boosted(data, pending, len(names)), []
    return BoostedModel(names, [Tree(t.feature, [float(cuts[f][a]) if f >= 0 else 0.0 for f, a in zip(t.feature, t.at)], t.left, t.value)
                                for t in trees], cuts)
