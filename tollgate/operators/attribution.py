"""Exact attribution of tree ensembles (path-dependent Shapley values).

The value of a set S of known features is the tree's mean prediction when splits on other
features are followed to both sides in proportion to their training rows.  Written over leaves
it is a sum of products: a leaf contributes its value times, for each feature on its path, 1 or
0 (does the row pass all splits on it?) if the feature is in S, else the share of training rows
that pass them.  With m features on a path, the Shapley weights k! (m - 1 - k)! / m! are the
integrals of t^k (1 - t)^(m - 1 - k) over [0, 1], so the value of feature i is

    sum over leaves of value * (pass_i - share_i) * integral of prod over j != i of
    (share_j * (1 - t) + pass_j * t)

and Gauss-Legendre quadrature with m / 2 nodes gives the integral of this polynomial exactly.

``path_table`` flattens a fitted model's trees to arrays over leaves and over edges (bounded by trees
and depth, whatever the data); ``tree_attribution`` runs one vectorised pass over the rows.  Leaves
share their paths' beginnings, so products are taken once an edge on the way down and sums over leaves
once an edge on the way up (``EdgeTable``).  Values are in
units of the score that trees add up: the probability of class 1 for forests, the margin for
boosted trees; they sum to the row's score minus ``expected``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Rows times path entries that a task holds at once.
CHUNK = 2_000_000
#: Edges of the trees taken together, and rows times edges at once (arrays that stay in the cache).
EDGES, EDGE_CHUNK = 2_000, 128_000


@dataclass
class EdgeTable:
    """Arrays over the edges of some trees, level by level, after a root edge that every row passes.

    An edge holds what the splits from the root down to it ask of its feature.  With g the
    (pass - share) / term of an edge and T the value times product summed over the leaves below, feature
    i gets the sum of T * (g of the edge - g of the edge above that last asked for i) over its edges."""

    levels: list          # slices of the levels
    parent: np.ndarray
    before: np.ndarray    # the edge above of the same feature, or the root edge
    feature: np.ndarray
    above: np.ndarray
    upto: np.ndarray
    share: np.ndarray
    value: np.ndarray     # of the leaf below, times its tree's weight; 0 if there is none

    def __post_init__(self):
        self.order = np.argsort(self.feature[1:], kind="stable") + 1
        self.first = np.flatnonzero(np.diff(self.feature[self.order], prepend=-1))
        self.starts = [np.flatnonzero(np.diff(self.parent[s], prepend=-1)) for s in self.levels]

    def attribution(self, x: np.ndarray, nodes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Features by rows, of the columns ``x`` (features by rows)."""
        out = np.zeros(x.shape)
        if not self.levels:
            return out
        here = x[self.feature]
        passes = ((here > self.above[:, None]) & (here <= self.upto[:, None])).astype(float)
        passes[0] = 1.0
        asked = passes - self.share[:, None]
        total, product = np.zeros(passes.shape), np.ones(passes.shape)
        for t, w in zip(nodes, weights):
            term = passes * t + (self.share * (1 - t))[:, None]           # positive: shares are
            step = term / term[self.before]
            for s in self.levels:
                np.multiply(product[self.parent[s]], step[s], out=product[s])
            below = product * (w * self.value)[:, None]
            for s, starts in zip(self.levels[:0:-1], self.starts[:0:-1]):
                here = below[s]
                paired = 2 * len(starts) == len(here) and (starts[1:] - starts[:-1] == 2).all()
                below[self.parent[s][starts]] += here[::2] + here[1::2] if paired else np.add.reduceat(here, starts, axis=0)
            g = asked / term
            g -= g[self.before]
            g *= below
            total += g
        out[self.feature[self.order][self.first]] = np.add.reduceat(total[self.order], self.first, axis=0)
        return out


def edge_table(trees: list) -> EdgeTable:
    """``trees``: (weight, nodes as in ``paths_of``) of each tree."""
    cols, levels = [(0, 0, 0, -np.inf, np.inf, 1.0, 0.0)], []
    level = [(nodes, w, 0, 0, {}) for w, nodes in trees]
    while level:
        following, start = [], len(cols)
        for nodes, w, i, edge, last in level:
            _, rows, left, right, feature, threshold = nodes[i]
            if left < 0:
                continue
            before = last.get(feature, 0)
            above, upto, share = cols[before][3:6]
            for child, span in ((left, (above, min(upto, threshold))), (right, (max(above, threshold), upto))):
                value, n, deeper = nodes[child][:3]
                if n > 0:  # a side that no training row took has no weight
                    following.append((nodes, w, child, len(cols), {**last, feature: len(cols)}))
                    cols.append((edge, before, feature, *span, share * n / rows, w * value if deeper < 0 else 0.0))
        if following:
            levels.append(slice(start, len(cols)))
        level = following
    parent, before, feature, above, upto, share, value = map(np.array, zip(*cols))
    return EdgeTable(levels, parent, before, feature, above, upto, share, value)


def edge_tables(trees: list) -> list[EdgeTable]:
    """Trees taken together up to about ``EDGES`` edges."""
    groups, size = [], EDGES
    for weight, nodes in trees:
        if size >= EDGES:
            groups.append([])
            size = 0
        groups[-1].append((weight, nodes))
        size += len(nodes)
    return [edge_table(g) for g in groups]


@dataclass
class PathTable:
    """Arrays over leaves (by path length: one entry for each distinct feature of the path)."""

    value: np.ndarray                              # of each leaf, times its tree's weight
    feature: np.ndarray = field(repr=False)        # leaves x longest path, 0 where unused
    above: np.ndarray = field(repr=False)          # the row passes if above < x <= upto
    upto: np.ndarray = field(repr=False)
    share: np.ndarray = field(repr=False)          # of training rows that pass; 1 where unused
    expected: float = 0.0                          # score without any known feature
    edges: list = field(default_factory=list, repr=False)  # the same trees by edges, if they are known

    def attribution(self, x: np.ndarray, n_features: int) -> np.ndarray:
        """Rows by features."""
        out = np.zeros((len(x), n_features))
        longest = max(1, self.feature.shape[1])
        nodes, weights = np.polynomial.legendre.leggauss((longest + 1) // 2)
        nodes, weights = (nodes + 1) / 2, weights / 2
        if self.edges:
            for e in self.edges:
                for rows in np.array_split(np.arange(len(x)), max(1, len(x) * len(e.parent) // EDGE_CHUNK)):
                    out[rows] += e.attribution(np.ascontiguousarray(x[rows].T), nodes, weights).T
            return out
        for rows in np.array_split(np.arange(len(x)), max(1, len(x) * self.feature.size // CHUNK)):
            here = x[rows][:, self.feature]                                   # rows x leaves x path
            passes = ((here > self.above) & (here <= self.upto)).astype(float)
            total = np.zeros(passes.shape)
            for t, w in zip(nodes, weights):
                term = self.share * (1 - t) + passes * t                      # positive: shares are
                total += (w * term.prod(axis=2) * self.value)[:, :, None] / term
            total *= passes - self.share
            flat = self.feature.ravel()
            order = np.argsort(flat, kind="stable")
            first = np.flatnonzero(np.diff(flat[order], prepend=-1))
            if len(first):
                out[np.ix_(rows, flat[order][first])] = np.add.reduceat(total.reshape(len(rows), -1)[:, order], first, axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        here = x[:, self.feature]
        return ((here > self.above) & (here <= self.upto)).all(axis=2) @ self.value


def paths_of(nodes: dict, root: int = 0) -> list:
    """(leaf value, {feature: (above, upto, share)}) of a tree given as id -> (value, rows, left,
    right, feature, threshold); a leaf has left -1."""
    out, todo = [], [(root, {})]
    while todo:
        i, path = todo.pop()
        value, rows, left, right, feature, threshold = nodes[i]
        if left < 0:
            out.append((value, path))
            continue
        above, upto, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, span in ((left, (above, min(upto, threshold))), (right, (max(above, threshold), upto))):
            if nodes[child][1] > 0:  # a side that no training row took has no weight
                todo.append((child, {**path, feature: (*span, share * nodes[child][1] / rows)}))
    return out


def table_of(trees: list) -> PathTable:
    """``trees``: (weight, paths) of each tree."""
    leaves = [(w * v, path) for w, paths in trees for v, path in paths]
    longest = max([1, *(len(p) for _, p in leaves)])
    feature = np.zeros((len(leaves), longest), np.int64)
    above, upto = np.full(feature.shape, -np.inf), np.full(feature.shape, np.inf)
    share = np.ones(feature.shape)
    for i, (_, path) in enumerate(leaves):
        for j, (f, (a, b, s)) in enumerate(path.items()):
            feature[i, j], above[i, j], upto[i, j], share[i, j] = f, a, b, s
    value = np.array([v for v, _ in leaves])
    return PathTable(value, feature, above, upto, share, float(value @ share.prod(axis=1)))


def path_table(spark: SparkSession, model) -> PathTable:
    """The paths of a fitted forest or boosted model, read from its saved node table."""
    if not isinstance(model, (RandomForestClassificationModel, GBTClassificationModel)):
        raise TypeError(f"no trees in {type(model).__name__}")
    forest = isinstance(model, RandomForestClassificationModel)
    path = scratch_path(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").collect()  # trees times nodes
    trees: dict = {}
    for r in rows:
        stats, split = list(r["impurityStats"]), r["split"]
        if r["leftChild"] >= 0 and split["numCategories"] >= 0:
            raise ValueError("categorical splits have no threshold")
        value = stats[1] / sum(stats) if forest else r["prediction"]
        n = sum(stats) if forest else stats[0]
        threshold = split["leftCategoriesOrThreshold"][0] if r["leftChild"] >= 0 else 0.0
        trees.setdefault(r["tree"], {})[r["id"]] = (value, n, r["leftChild"], r["rightChild"], split["featureIndex"], threshold)
    weights = [1 / len(trees)] * len(trees) if forest else model.treeWeights
    table = table_of([(weights[i], paths_of(trees[i])) for i in sorted(trees)])
    table.edges = edge_tables([(weights[i], trees[i]) for i in sorted(trees)])
    return table


def tree_attribution(rows: DataFrame, table: PathTable, names: list, key: str) -> DataFrame:
    """(key, feature, phi) of every row and feature, zero ones included, in one pass.  Missing
    values raise, as they do in the model."""
    x = rows.select(key, F.array(*[F.col(n).cast("double") for n in names]).alias("x"))
    shared = rows.sparkSession.sparkContext.broadcast(table)  # bounded by trees and depth
    d = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten()
            if flat.null_count:
                raise ValueError("missing feature values: impute them first")
            phi = shared.value.attribution(flat.to_numpy(zero_copy_only=False).reshape(-1, d), d)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(phi), pa.list_(pa.float64()))], names=[key, "phi"])

    values = x.mapInArrow(run, x.select(key).schema.add("phi", T.ArrayType(T.DoubleType())))
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("phi").alias("phi"))
    return values.select(key, F.inline(pairs).alias("feature", "phi"))
