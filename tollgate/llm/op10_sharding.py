"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that must stay together; a group's size is the sum of its
rows' bytes.  Groups go, largest first, to the least-loaded shard, ties to the smaller
shard number.  Equal sizes are scheduled as one run: only one row for each distinct group
size reaches the scheduling task (at most sqrt(2 * total bytes) of them, since distinct
sizes add up to no more than the total).  Short runs pop a heap of shard loads group by
group.  A long run of size s is laid out in windows of s bytes of load: within each window
every shard that the level has reached takes one group, in the order of its load, which is
exactly what the heap would do.  The task sends out (size, ranks from, ranks to, cycle of
shards); a group finds its shard by its rank among the groups of its size.

Ranks and slots are numbered in parts (``chunked_rank``), so neither a size that a third of
all groups share nor a shard passes through one task.

Defined cases: null text counts as empty and joins the group of empty texts; null doc_ids
and repeated rows are placed like others; fewer groups than shards leave shards empty; empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunked_rank, table, written
from .registry import register

SHARDS = 16
#: Rows that one part of a rank or of a shard's slots should hold.
PART_ROWS = 100_000


def place_run(heap: list, size: int, count: int) -> list[tuple[int, int, list[int]]]:
    """Gives ``count`` groups of ``size`` to the least-loaded shards and updates ``heap``, a
    heap of (load, shard).  Returns (first rank, ranks, cycle): rank r of the run goes to
    cycle[(r - first) % len(cycle)]."""
    if count <= 2 * len(heap):
        out = []
        for r in range(count):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            out.append((r, 1, [shard]))
        return out
    low = heap[0][0]
    # a shard joins in the window that its load lies in, at its place within the window
    joins = sorted(((load - low) // size, (load - low) % size, shard, load) for load, shard in heap)
    out, given, rank, window = [], dict.fromkeys((s for _, s in heap), 0), 0, 0
    active: list = []
    for k, (enters, place, shard, _) in enumerate(joins):
        active.append((place, shard))
        until = joins[k + 1][0] if k + 1 < len(joins) else None
        if until == enters:
            continue
        cycle = [s for _, s in sorted(active)]
        ranks = count - rank if until is None else min(count - rank, (until - enters) * len(cycle))
        out.append((rank, ranks, cycle))
        for i, s in enumerate(cycle):
            given[s] += ranks // len(cycle) + (i < ranks % len(cycle))
        rank += ranks
        if rank == count:
            break
    heap[:] = [(load + size * given[s], s) for load, s in heap]
    heapq.heapify(heap)
    return out


def schedule(sizes: DataFrame, shards: int) -> DataFrame:
    """(size, first, ranks, cycle) from (size, n), the number of groups of each size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = [(0, s) for s in range(shards)]
        for batch in batches:
            rows = [(size, *p) for size, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for p in place_run(heap, size, n)]
            yield pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate(("size", "first", "ranks", "cycle"))},
                                             schema=pa.schema([("size", pa.int64()), ("first", pa.int64()),
                                                               ("ranks", pa.int64()), ("cycle", pa.list_(pa.int32()))]))

    return (sizes.select("size", "n").repartition(1).sortWithinPartitions(F.desc("size"))
            .mapInArrow(run, "size long, first long, ranks long, cycle array<int>"))


def _digits(rows: int) -> int:
    """Leading hex digits that cut ``rows`` rows into parts of about PART_ROWS."""
    return max(1, math.ceil(math.log(max(1, rows / PART_ROWS), 16)))


def shard_rows(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = written(spark, docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("same")), "shard-rows")
    groups = narrow.groupBy("same").agg(F.sum("size").alias("total"))
    groups = written(spark, groups, "shard-groups")
    sizes = groups.groupBy(F.col("total").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    plan = schedule(sizes, shards).withColumnRenamed("size", "total")
    ranked = chunked_rank(groups, ["total"], F.substring("same", 1, _digits(groups.count())), [F.col("same")], "r")
    placed = ranked.join(plan, "total").where("r >= first AND r < first + ranks").select(
        "same", F.expr("get(cycle, int(pmod(r - first, size(cycle))))").alias("shard"))
    rows = narrow.join(placed, "same").withColumn("__id", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = chunked_rank(rows, ["shard"], F.substring("__id", 1, _digits(narrow.count()) + 1),
                        [F.col("__id"), F.col("same")], "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS ct FROM (
    SELECT i, list_reduce(list_prepend(i, range(0, 8)),
      lambda x, k: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(0, 256) AS r(i))),
rows_ AS (SELECT doc_id, CAST(octet_length(encode(t)) + 1 AS BIGINT) AS size, md5(t) AS same, t FROM d),
groups_ AS (SELECT same, sum(size) AS total, row_number() OVER (ORDER BY sum(size) DESC, same) AS i FROM rows_ GROUP BY same),
lpt AS (
  SELECT CAST(0 AS BIGINT) AS i, list_transform(range(0, 16), lambda x: CAST(0 AS HUGEINT)) AS loads, CAST(NULL AS INTEGER) AS shard
  UNION ALL
  SELECT g.i, list_transform(range(0, 16), lambda x: CASE WHEN x + 1 = list_position(l.loads, list_min(l.loads))
           THEN l.loads[x + 1] + g.total ELSE l.loads[x + 1] END),
         CAST(list_position(l.loads, list_min(l.loads)) - 1 AS INTEGER)
  FROM lpt l JOIN groups_ g ON g.i = l.i + 1),
texts AS (SELECT same, any_value(t) AS t FROM rows_ GROUP BY same),
crcs AS (
  SELECT same, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(t)), '..'),
    lambda h: CAST('0x' || h AS BIGINT))),
    lambda x, b: xor(x >> 8, ct[(xor(x, b) & 255) + 1])), 4294967295) AS crc FROM texts, crc_table)
SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), same) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM rows_ JOIN groups_ USING (same) JOIN lpt USING (i) JOIN crcs USING (same)
"""


@register("op10_lpt_sharding", ORACLE)
def op10_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(spark, table(spark, sf_dir, "documents"))
