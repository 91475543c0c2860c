"""Exact top-k search by inner product, by a three-phase uniform threshold.

The dimensions are cut into ``LISTS`` segments; a candidate's score is the sum of its local
scores over the segments, and each segment ranks all candidates for a query.

1. Gather: every block of candidates takes each query's best k + 1 of each local list.  The
   totals of these entries are lower bounds; the (k + 1)-th largest over all blocks is a safe
   cutoff: no better answer can have less.
2. Broadcast and collect: the cutoffs go with the query blocks to all candidate blocks.  An
   entry whose local scores are all below cutoff / LISTS has a total below the cutoff, so
   blocks collect only the entries that reach that uniform threshold in some list, and drop
   those whose upper bound (the threshold for the lists not reached) misses the cutoff.
3. Resolve: the missing local scores of what is left are added exactly; a block sends out
   its best k + 1, and the best of all blocks are ranked.

A component x becomes floor(1024 * x); scores are exact integers (in doubles while the bound
stays below 2^53, else in Python integers); beyond the range of a long they are its ends.

Equal vectors are collapsed before the search: of a vector only the k + 1 smallest ids can
matter (k and the query's own), and equal queries are searched once.  So a vector shared by
a third of all rows costs one entry.  Queries and candidates meet in blocks of QUERY_ROWS by
CANDIDATE_ROWS vectors: a stated query set against all rows, no row-wise cross join.

Defined cases: vectors that are null or hold null, NaN or infinite components, and rows
with null ids, take no part; rows equal in id and vector count once; vectors meet only
vectors of their own length; ties go to the smaller id; a query with fewer candidates
gets them all; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .registry import register

K = 10
LISTS = 4
QUERY_ROWS = 256
CANDIDATE_ROWS = 4096
#: Candidate blocks that meet a copy of a query block in one place, once there are many.
BLOCKS_TOGETHER = 64


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): the usable rows with integer components."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(ok).select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * 1024.0).cast("long")).alias("v"))


def _packed(df: DataFrame, rows: int, with_ids: bool) -> DataFrame:
    """Vectors (v, and ids) packed into blocks of one length: block, d, n, data, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}

        def out(d: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            rows_ = waiting.pop(d)
            data = np.array([v for v, _ in rows_], dtype="<i8").reshape(len(rows_), d)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | made]), pa.array([d], pa.int32()), pa.array([len(rows_)], pa.int32()),
                pa.array([data.tobytes()], pa.binary()), pa.array([[ids for _, ids in rows_]], pa.list_(pa.list_(pa.int64())))],
                names=["block", "d", "n", "data", "ids"])

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                ids = some.column(1).to_pylist() if with_ids else [[]] * some.num_rows
                for v, i in zip(some.column(0).to_pylist(), ids):
                    waiting.setdefault(len(v), []).append((v, i))
                    if len(waiting[len(v)]) == rows:
                        yield out(len(v))
        for d in list(waiting):
            yield out(d)

    return df.mapInArrow(run, "block long, d int, n int, data binary, ids array<array<long>>")


def _segments(d: int) -> list[slice]:
    cuts = np.linspace(0, d, min(LISTS, max(1, d)) + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def _local_scores(q: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """One matrix of local scores (queries by candidates) for each segment, exact."""
    d = q.shape[1]
    bound = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * max(1, d)
    kind = np.float64 if bound < 2**53 else object
    q, c = q.astype(kind), c.astype(kind)
    return [q[:, s] @ c[:, s].T if s.stop > s.start else np.zeros((len(q), len(c)), kind) for s in _segments(d)]


def _best(row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest values, in any order."""
    if len(row) <= k:
        return np.arange(len(row))
    if row.dtype == object:
        return np.array(sorted(range(len(row)), key=lambda i: -row[i])[:k])
    return np.argpartition(row, len(row) - k)[len(row) - k:]


def _arrays(batch: pa.RecordBatch, i: int, prefix: str) -> np.ndarray:
    n, d = batch.column(f"{prefix}n")[i].as_py(), batch.column("d")[i].as_py()
    return np.frombuffer(batch.column(f"{prefix}data")[i].as_py(), "<i8").reshape(n, d)


def _lower_bounds(k: int):
    """Phase 1 on pairs of blocks: (block, idx, bounds), the k largest totals found for a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, c = _arrays(batch, i, "q"), _arrays(batch, i, "c")
                copies = np.array([min(k, len(x)) for x in batch.column("cids")[i].as_py()])
                lists = _local_scores(q, c)
                bounds = []
                for r in range(len(q)):
                    seen = np.unique(np.concatenate([_best(m[r], k) for m in lists]))
                    total = sum(m[r][seen] for m in lists)
                    total = np.repeat(total, copies[seen])
                    bounds.append(sorted((int(x) for x in total[_best(total, k)]), reverse=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[i].as_py()] * len(q)), pa.array(range(len(q)), pa.int32()),
                    pa.array([[max(-2**63, min(2**63 - 1, x)) for x in b] for b in bounds], pa.list_(pa.int64()))],
                    names=["block", "idx", "bounds"])

    return run


def _above(k: int):
    """Phases 2 and 3 on pairs of blocks that carry cutoffs: (block, idx, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, c = _arrays(batch, i, "q"), _arrays(batch, i, "c")
                ids, cutoffs = batch.column("cids")[i].as_py(), batch.column("cutoffs")[i].as_py()
                lists = _local_scores(q, c)
                out: list = []
                for r in range(len(q)):
                    if cutoffs[r] is None:  # fewer than k answers in all: every entry is sufficient
                        places = np.arange(len(c))
                    else:
                        each = cutoffs[r] / len(lists)
                        reach = [m[r] >= each for m in lists]
                        places = np.flatnonzero(np.logical_or.reduce(reach))
                        upper = sum(np.where(h[places], m[r][places], each) for m, h in zip(lists, reach))
                        # the bound is a sum of doubles: leave room for its rounding
                        places = places[upper >= cutoffs[r] - 1 - abs(cutoffs[r]) * 1e-9]
                    if not len(places):
                        continue
                    total = sum(m[r][places] for m in lists)
                    if cutoffs[r] is not None:
                        keep = total >= cutoffs[r]
                        places, total = places[keep], total[keep]
                    total = [max(-2**63, min(2**63 - 1, int(s))) for s in total]
                    found = sorted((-s, x) for p, s in zip(places.tolist(), total) for x in ids[p])[:k]
                    out += [(r, x, -s) for s, x in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[i].as_py()] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int32()),
                    pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())],
                    names=["block", "idx", "id", "score"])

    return run


def _largest(k: int):
    """The k-th largest of all bounds of a query block's queries; null if there are fewer."""

    def run(t: pa.Table) -> pa.Table:
        best: dict[int, list] = {}
        for idx, b in zip(t.column("idx").to_pylist(), t.column("bounds").to_pylist()):
            best[idx] = sorted(best.get(idx, []) + b, reverse=True)[:k]
        cut = [best[i][k - 1] if len(best[i]) >= k else None for i in range(len(best))]
        return pa.table({"block": [t.column("block")[0].as_py()], "cutoffs": pa.array([cut], pa.list_(pa.int64()))})

    return run


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score from (id, v) rows; ``is_query`` chooses the queries by id."""
    more = k + 1  # the query itself may be among them
    by_vector = Window.partitionBy("v").orderBy("id")
    candidates = (vectors.withColumn("place", F.dense_rank().over(by_vector)).where(F.col("place") <= more)
                  .groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    cblocks = written(spark, _packed(candidates.select("v", "ids"), CANDIDATE_ROWS, True), "topk-candidates")
    asked = vectors.where(is_query).distinct()
    qblocks = written(spark, _packed(asked.select("v").distinct().select("v", F.lit(None).alias("ids")),
                                     QUERY_ROWS, False), "topk-queries")
    n_blocks = cblocks.count()
    groups = max(1, min(n_blocks, BLOCKS_TOGETHER), n_blocks // BLOCKS_TOGETHER)
    c = cblocks.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("g"), "d", F.col("n").alias("cn"),
                       F.col("data").alias("cdata"), F.col("ids").alias("cids"))

    def pairs(q: DataFrame, *more_columns: str) -> DataFrame:
        q = q.select("block", "d", F.col("n").alias("qn"), F.col("data").alias("qdata"), *more_columns,
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
        return q.join(c, ["g", "d"])

    bounds = pairs(qblocks).mapInArrow(_lower_bounds(more), "block long, idx int, bounds array<long>")
    # of a task's blocks only the best bounds of a query go on
    best = bounds.select("block", "idx", F.explode("bounds").alias("b"))
    by_query = Window.partitionBy("block", "idx").orderBy(F.desc("b"))
    best = (best.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= more)
            .groupBy("block", "idx").agg(F.collect_list("b").alias("bounds")))
    cutoffs = best.groupBy("block").applyInArrow(_largest(more), "block long, cutoffs array<long>")
    found = pairs(qblocks.join(cutoffs, "block"), "cutoffs").mapInArrow(
        _above(more), "block long, idx int, id long, score long")
    by_query = Window.partitionBy("block", "idx").orderBy(F.desc("score"), "id")
    found = found.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= more)
    answers = found.groupBy("block", "idx").agg(F.collect_list(F.struct("place", "id", "score")).alias("answers"))
    vectors_of = qblocks.mapInArrow(_unpacked, "block long, idx int, v array<long>")
    answers = vectors_of.join(answers, ["block", "idx"]).select("v", "answers")
    ranked = (asked.join(answers, "v").select(F.col("id").alias("query_id"), F.explode("answers").alias("a"))
              .where("a.id <> query_id"))
    # at most k + 1 rows of a query, numbered without the query's own
    lists = ranked.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("a.place", "a.id", "a.score"))), 1, k).alias("l"))
    return lists.select("query_id", F.posexplode("l").alias("p", "a")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("a.id").alias("vec_id"), F.col("a.score").alias("score"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            n, d = batch.column("n")[i].as_py(), batch.column("d")[i].as_py()
            v = np.frombuffer(batch.column("data")[i].as_py(), "<i8").reshape(n, d)
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.column("block")[i].as_py()] * n), pa.array(range(n), pa.int32()),
                pa.array(v.tolist(), pa.list_(pa.int64()))], names=["block", "idx", "v"])


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 10
"""


@register("op1_topk_search", ORACLE)
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(spark, vectors, F.col("id") % 100 == 0)
