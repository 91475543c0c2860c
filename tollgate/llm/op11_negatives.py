"""Hard negatives by a vertical scan (BOND) over columnar blocks of vectors.

Rows are packed into blocks of ``BLOCK_ROWS`` that hold one array for each dimension.  For an anchor,
a block's dimensions are read in the order of the anchor's component magnitudes, largest first,
``STEP`` at a time.  What the dimensions not yet read can still add lies between bounds known from
each dimension's minimum and maximum in the block, so every candidate has a lower and an upper
score, and the bitmap of candidates shrinks after each step:

* positives (same label): a candidate goes when its upper score misses the k-th best lower score;
* negatives (another label): a candidate goes when its bounds miss the windows of all positives, or
  when enough candidates certainly inside a window have lower scores above its upper score.

Scores left after the last dimension are exact.  Both phases run anchors in blocks of ``ANCHOR_ROWS``
against all blocks, a stated query set against all rows; the best of each block are ranked.

Rows equal in vector and label are collapsed first (only their smallest ids can matter), and anchors
equal in both are searched once, so a vector shared by a third of all rows costs one entry.

Defined cases: rows whose id, label or vector is null, or whose vector holds null, NaN or infinite
components, take no part; rows equal in id, label and vector count once; a row is never its own
positive; vectors meet only vectors of their own length; scores are exact integers (beyond 2^53
computed in Python integers, beyond a long its ends); a positive score below zero has an empty window;
anchors without positives or negatives give no rows; empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffles_removed, table, written
from .registry import register

POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score between which a negative's score lies.
WINDOW = (30, 90)
ANCHOR_ROWS = 128
BLOCK_ROWS = 8192
#: Dimensions read between two looks at the bounds.
STEP = 8
#: Candidate blocks that meet a copy of an anchor block in one place, once there are many.
BLOCKS_TOGETHER = 32
BLOCKS = "block long, d int, n int, data binary, labels array<long>, ids array<array<long>>"


def labelled_vectors(df: DataFrame, scale: int, label: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, label, v): the usable rows with components floor(scale * x)."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & label.isNotNull()).where(ok)
            .select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")).alias("v")).distinct())


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """(v, label, ids) rows as blocks of vectors of one length, dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}

        def out(d: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            v, labels, ids = zip(*waiting.pop(d))
            data = np.array(v, dtype="<i8").reshape(len(v), d)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | made]), pa.array([d], pa.int32()), pa.array([len(v)], pa.int32()),
                pa.array([np.ascontiguousarray(data.T).tobytes()], pa.binary()), pa.array([list(labels)], pa.list_(pa.int64())),
                pa.array([list(ids)], pa.list_(pa.list_(pa.int64())))], names=["block", "d", "n", "data", "labels", "ids"])

        for batch in batches:
            for v, label, ids in zip(*(c.to_pylist() for c in batch.columns)):
                waiting.setdefault(len(v), []).append((v, label, ids))
                if len(waiting[len(v)]) == rows:
                    yield out(len(v))
        for d in list(waiting):
            yield out(d)

    return df.select("v", "label", "ids").mapInArrow(run, BLOCKS)


class Block:
    """Columns of a block of candidates with each dimension's least and largest value."""

    def __init__(self, columns: np.ndarray, labels: np.ndarray, ids: list, largest: float):
        bound = float(np.abs(columns.astype(np.float64)).max(initial=0)) * largest * max(1, len(columns))
        self.kind = np.float64 if bound < 2**53 else object
        self.columns, self.labels, self.ids = columns.astype(self.kind), labels, ids
        self.least, self.most = (f(axis=1) if len(labels) else np.zeros(len(columns)) for f in (self.columns.min, self.columns.max))

    def scan(self, q: np.ndarray, alive: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of the candidates that ``prune(lower, upper)`` keeps to the end."""
        q = q.astype(self.kind)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack([q * self.least, q * self.most])[:, order]
        rest = np.cumsum(np.concatenate([[[0], [0]], np.sort(ends, axis=0)[:, ::-1]], axis=1), axis=1)[:, ::-1]  # still to come: least, most
        places = np.flatnonzero(alive)
        score = np.zeros(len(places), self.kind)
        for at in range(0, len(order), STEP):
            if not len(places):
                break
            dims = order[at:at + STEP]
            score = score + q[dims] @ self.columns[np.ix_(dims, places)]
            low, high = rest[:, min(at + STEP, len(order))]
            keep = prune(score + low, score + high)
            places, score = places[keep], score[keep]
        return places, score


def _kth(values: np.ndarray, k: int):
    """The k-th largest value; None if there are fewer."""
    if len(values) < k:
        return None
    return sorted(values.tolist())[-k] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


def _best(block: Block, places: np.ndarray, score: np.ndarray, k: int) -> list:
    """The k best (id, score), ties to smaller ids."""
    if (cut := _kth(score, k)) is not None:
        places, score = places[score >= cut], score[score >= cut]
    found = [(-max(-2**63, min(2**63 - 1, int(s))), i) for p, s in zip(places.tolist(), score.tolist()) for i in block.ids[p]]
    return [(i, -s) for s, i in sorted(found)[:k]]


def positives_of(block: Block, q: np.ndarray, label: int, k: int) -> list:
    """The k best (id, score) of the label in a block."""

    def prune(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        cut = _kth(low, k)
        return np.ones(len(low), bool) if cut is None else high >= cut

    return _best(block, *block.scan(q, block.labels == label, prune), k)


def negatives_of(block: Block, q: np.ndarray, label: int, scores: list, window: tuple, k: int) -> list:
    """(positive score, id, score): the k best of other labels in the window of each positive score."""
    windows = [(p, -(-window[0] * p // 100), window[1] * p // 100) for p in scores if p >= 0]

    def prune(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for _, a, b in windows:
            near = (high >= a) & (low <= b)
            if (cut := _kth(low[(low >= a) & (high <= b)], k)) is not None:
                near &= high >= cut
            keep |= near
        return keep

    places, score = block.scan(q, block.labels != label, prune) if windows else (np.zeros(0, int), np.zeros(0))
    out = []
    for p, a, b in windows:
        here = (score >= a) & (score <= b)
        out += [(p, i, s) for i, s in _best(block, places[here], score[here], k)]
    return out


def _pairs(search, schema: str):
    """Runs ``search(block, vector, label, wanted)`` for every anchor of every pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q = np.frombuffer(row["qdata"], "<i8").reshape(row["d"], row["qn"]).T
                columns = np.frombuffer(row["data"], "<i8").reshape(row["d"], row["n"])
                block = Block(columns, np.array(row["labels"], np.int64), row["ids"], float(np.abs(q.astype(np.float64)).max(initial=0)))
                wanted = dict(row.get("wanted") or [])
                out = [(row["block"], i, *x) for i, (v, label) in enumerate(zip(q, row["qlabels"]))
                       for x in search(block, v, label, wanted.get(i, []))]
                cols = list(zip(*out)) if out else [[]] * len(schema.split(","))
                kinds = [pa.int32() if f.split()[1] == "int" else pa.int64() for f in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in schema.split(", ")])

    return run


def hard_negatives(spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, window: tuple = WINDOW) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score from (id, label, v)
    rows; ``is_anchor`` chooses the anchors by id."""
    more = positives + 1  # the anchor itself may be among them
    smallest = Window.partitionBy("v", "label").orderBy("id")
    kept = vectors.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= max(more, negatives))
    with shuffles_removed(spark):
        candidates = written(spark, _packed(kept.groupBy("v", "label").agg(F.sort_array(F.collect_list("id")).alias("ids")),
                                            BLOCK_ROWS), "negatives-blocks")
        anchors = written(spark, vectors.where(is_anchor), "negatives-anchors")
        asked = written(spark, _packed(anchors.select("v", "label").distinct().withColumn("ids", F.array().cast("array<long>")),
                                       ANCHOR_ROWS), "negatives-asked")
    n_blocks = candidates.count()
    groups = max(1, min(n_blocks, BLOCKS_TOGETHER), n_blocks // BLOCKS_TOGETHER)
    c = candidates.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("g"), F.col("block").alias("other"), "d", "n", "data", "labels", "ids")

    def met(q: DataFrame, *columns: str) -> DataFrame:
        q = q.select("block", "d", F.col("n").alias("qn"), F.col("data").alias("qdata"), F.col("labels").alias("qlabels"), *columns,
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
        return q.join(c, ["g", "d"]).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block", "other")

    schema = "block long, idx int, id long, score long"
    near = met(asked).mapInArrow(_pairs(lambda b, v, label, _: positives_of(b, v, label, more), schema), schema)
    best = Window.partitionBy("block", "idx").orderBy(F.desc("score"), "id")
    near = written(spark, near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= more), "negatives-positives")
    wanted = near.groupBy("block", "idx").agg(F.collect_set("score").alias("scores")).groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("idx", "scores"))).alias("wanted"))
    schema = "block long, idx int, positive_score long, id long, score long"
    far = met(asked.join(wanted, "block"), "wanted").mapInArrow(
        _pairs(lambda b, v, label, scores: negatives_of(b, v, label, scores, window, negatives), schema), schema)
    best = Window.partitionBy("block", "idx", "positive_score").orderBy(F.desc("score"), "id")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    # a list holds at most ``more`` positives; the anchor itself leaves it
    lists = near.groupBy("block", "idx").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("list"))
    of = asked.mapInArrow(_unpacked, "block long, idx int, label long, v array<long>").join(lists, ["block", "idx"])
    own = anchors.select(F.col("id").alias("anchor_id"), "label", "v").join(of, ["v", "label"])
    own = own.select("anchor_id", "block", "idx", F.explode(F.slice(F.filter("list", lambda x: x["id"] != F.col("anchor_id")), 1, positives)).alias("p"))
    return (own.select("anchor_id", "block", "idx", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
            .join(far, ["block", "idx", "positive_score"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.select(["block", "d", "n", "data", "labels"]).to_pylist():
            v = np.frombuffer(row["data"], "<i8").reshape(row["d"], row["n"]).T
            yield pa.RecordBatch.from_arrays([
                pa.array([row["block"]] * row["n"], pa.int64()), pa.array(range(row["n"]), pa.int32()), pa.array(row["labels"], pa.int64()),
                pa.array(v.tolist(), pa.list_(pa.int64()))], names=["block", "idx", "label", "v"])


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a, v b WHERE a.id % 100 = 0 AND b.id <> a.id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@register("op11_hard_negatives", ORACLE)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(table(spark, sf_dir, "embeddings"), 256, moved)
    return hard_negatives(spark, vectors, F.col("id") % 100 == 0)
