"""R6 and R7 as keyed state over several micro-batches.

``first_steps`` keeps, for every anchor event and step, the first step event inside its day window
(earliest time, then smallest event id), as a batch run over all events would.

* State is keyed by time bucket and, for whole-number entities, by one of ``shards`` groups of them
  (each key costs a call to Python); other entities are keyed one by one.  So a hot entity is spread over
  its buckets.  An anchor lies in one bucket; a step event goes to the buckets whose anchors its window
  reaches: two or three for buckets as long as the longest window.  A key holds its entities' rows of
  one bucket and the windows behind it; ``bucket_days`` and ``shards`` make keys finer.
* A key's state holds anchors whose windows are still open and step events that these, or anchors
  still to come, can use.  All anchors of a key search the sorted step events at once: nothing is
  emitted pair by pair.
* An event-time timer at the first closing window emits that anchor's rows; a key without open
  anchors goes when the watermark has passed its bucket.
* Rows older than the watermark (of the micro-batch before) are dropped, as by every watermarked
  operator, and so are rows without a time.  An anchor without an entity matches nothing.
  Repeated anchors give repeated rows.

``upsert_running_counts`` writes running counts in update mode: each micro-batch overwrites the
folder of its own batch id with the new values of the keys it touched, so a replayed batch leaves the
table as it was.  ``running_counts`` reads the newest value of each key; ``compact`` folds finished
batches into one snapshot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import scratch_path

DAY = 86_400_000_000  # microseconds
ANCHOR = -1
#: Groups of entities in a time bucket.
SHARDS = 512


def _state_columns(blob, width: int) -> np.ndarray:
    return np.frombuffer(bytes(blob), np.int64).reshape(width, -1)


def first_at(found: np.ndarray, who: np.ndarray, since: np.ndarray) -> np.ndarray:
    """How many of the events (times, ids, entities; sorted by entity, then time) come before (who, since)."""
    n = found.shape[1]
    is_event = np.arange(n + len(who)) < n
    order = np.lexsort((is_event, np.concatenate([found[0], since]), np.concatenate([found[2], who])))
    before = np.empty(len(order), np.int64)
    before[order] = np.cumsum(is_event[order])
    return before[n:]


def first_steps(events: DataFrame, anchor_type: str, spec, delay: str = "1 hour", bucket_days: int | None = None,
                entity: str = "user_id", ts: str = "ts", kind: str = "event_type", event_id: str = "event_id",
                shards: int = SHARDS) -> DataFrame:
    """(anchor_id, entity_id, anchor_ts, step, step_id, step_ts) of every anchor and step of ``spec``,
    once the watermark has passed the anchor's last window.  A window of lo to hi days holds
    step times of at least lo and less than hi + 1 days after the anchor."""
    steps = [(s.name, s.value, s.lo, s.hi) for s in spec.steps]
    width = (bucket_days or max(hi - lo + 1 for _, _, lo, hi in steps)) * DAY
    last = (max(hi for *_, hi in steps) + 1) * DAY
    earliest = min(lo for _, _, lo, _ in steps) * DAY

    def bucket(us):
        return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("long")

    def role(number: int, value: str, lo_us: int, hi_us: int):
        # anchors that this row concerns lie between lo_us and hi_us after it
        reach = F.sequence(bucket(F.col("us") + F.lit(lo_us)), bucket(F.col("us") + F.lit(hi_us)))
        return F.when(F.col(kind) == value, F.transform(reach, lambda b: F.struct(b.alias("bucket"), F.lit(number).alias("role"))))

    ev = (events.select(F.col(event_id).cast("long").alias("event_id"), F.col(entity).alias("entity_id"), kind,
                        F.col(ts).cast("timestamp").alias("ts"))
          .where(F.col("ts").isNotNull() & F.col(kind).isin(anchor_type, *[v for _, v, _, _ in steps]))
          .withWatermark("ts", delay).withColumn("us", F.unix_micros("ts")))
    roles = F.concat(*[F.coalesce(r, F.array().cast("array<struct<bucket: bigint, role: int>>")) for r in (
        role(ANCHOR, anchor_type, 0, 0),
        *[role(i, v, -(hi + 1) * DAY + 1, -lo * DAY) for i, (_, v, lo, hi) in enumerate(steps)])])
    sharded = isinstance(events.schema[entity].dataType, T.IntegralType)
    if sharded:  # without an entity: no shard
        shard = F.when(F.col("entity_id").isNotNull(), F.pmod(F.xxhash64("entity_id"), F.lit(shards)).cast("int"))
        who = F.coalesce(F.col("entity_id").cast("long"), F.lit(0).cast("long"))
    else:
        shard, who = F.col("entity_id"), F.lit(0).cast("long")
    rows = ev.select("event_id", "ts", "us", shard.alias("shard"), who.alias("who"), F.explode(roles).alias("r")).select(
        "event_id", "ts", "us", "shard", "who", F.col("r.bucket").alias("bucket"), F.col("r.role").alias("role"))

    def advance(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        end = (int(key[1]) + 1) * width
        anchors, found = np.empty((3, 0), np.int64), np.empty((4, 0), np.int64)  # (time, id, who), (time, id, who, role)
        if state.exists:
            anchors, found = (_state_columns(b, n) for b, n in zip(state.get, (3, 4)))
        for f in frames if not state.hasTimedOut else ():
            new, is_anchor = f[["us", "event_id", "who", "role"]].to_numpy(np.int64).T, (f["role"] == ANCHOR).to_numpy()
            anchors = np.concatenate([anchors, new[:3, is_anchor]], axis=1)
            if not pd.isna(key[0]):
                found = np.concatenate([found, new[:, ~is_anchor]], axis=1)
        now = state.getCurrentWatermarkMs() * 1000
        closed = anchors[0] + last < now
        if closed.any():
            yield matches(key[0], anchors[:, closed], found)
        anchors = anchors[:, ~closed]
        coming = [now] if end > now else []  # anchors still to come are not older than the watermark
        if not len(anchors[0]) and not coming:
            if state.exists:
                state.remove()
            return
        found = found[:, found[0] >= min([*coming, *anchors[0, :].min(initial=np.iinfo(np.int64).max, keepdims=True)]) + earliest]
        state.update((anchors.tobytes(), found.tobytes()))
        state.setTimeoutTimestamp(max(1, int(anchors[0].min() + last if len(anchors[0]) else end) // 1000))

    def matches(shard, anchors: np.ndarray, found: np.ndarray) -> pd.DataFrame:
        out, found = [], found[:, np.lexsort((found[1], found[0], found[2]))]
        entities = pd.Series(anchors[2], dtype="Int64") if sharded and not pd.isna(shard) else None if sharded else shard
        for number, (name, _, lo, hi) in enumerate(steps):
            mine = found[:, found[3] == number]
            at = first_at(mine, anchors[2], anchors[0] + lo * DAY)
            times, ids, whose = (np.append(mine[i], np.iinfo(np.int64).max)[at] for i in range(3))
            hit = (at < mine.shape[1]) & (whose == anchors[2]) & (times < anchors[0] + (hi + 1) * DAY)
            out.append(pd.DataFrame({"anchor_id": anchors[1], "entity_id": entities, "anchor_us": anchors[0], "step": name,
                                     "step_id": pd.Series(ids, dtype="Int64").where(hit), "step_us": pd.Series(times, dtype="Int64").where(hit)}))
        return pd.concat(out, ignore_index=True)

    kept = rows.groupBy("shard", "bucket").applyInPandasWithState(
        advance, f"anchor_id long, entity_id {events.schema[entity].dataType.simpleString()}, anchor_us long, step string, step_id long, step_us long",
        "anchors binary, steps binary", "append", GroupStateTimeout.EventTimeTimeout)
    return kept.select("anchor_id", "entity_id", F.timestamp_micros("anchor_us").alias("anchor_ts"), "step", "step_id",
                       F.timestamp_micros("step_us").alias("step_ts"))


def in_slices(df: DataFrame, ts: str, slices: int, run) -> None:
    """Feeds a table to a stream in ``slices`` of equal time spans: each is appended to a folder, then
    ``run(stream of that folder)`` takes all its files as one micro-batch and goes on from its checkpoint,
    as an incremental job would.  Rows without a time go with the first slice."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "slices")
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi = df.agg(F.min(us), F.max(us)).first()
    lo, span = lo or 0, max((hi or 0) - (lo or 0), 1)
    at = F.coalesce(F.least(F.floor((us - F.lit(lo)) * F.lit(slices) / F.lit(span)), F.lit(slices - 1)), F.lit(0))
    for i in range(slices):
        df.where(at == i).write.mode("append").parquet(path)
        run(spark.readStream.schema(df.schema).parquet(path))


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Batch id -> folder, of those written to the end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [x.getPath().getParent().toString() for x in fs.globStatus(p) or []]
    return {int(d.rsplit("batch=", 1)[1]): d for d in done}


def put_batch(counts: DataFrame, batch_id: int, path: str) -> None:
    """The new values of one micro-batch, under its id; writing it again replaces it."""
    counts.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")


def running_counts(spark: SparkSession, path: str, keys: list, through: int | None = None) -> DataFrame:
    """Newest row of every key, up to a batch id."""
    snapshots = {b: d for b, d in _folders(spark, f"{path}/snapshots").items() if through is None or b <= through}
    since = max(snapshots, default=-1)
    changes = [d for b, d in sorted(_folders(spark, f"{path}/changes").items()) if b > since and (through is None or b <= through)]
    parts = [spark.read.option("basePath", f"{path}/{kind}").parquet(*dirs) for kind, dirs in
             (("snapshots", [snapshots[since]] if snapshots else []), ("changes", changes)) if dirs]
    if not parts:
        raise FileNotFoundError(f"no finished batch in {path}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


def compact(spark: SparkSession, path: str, keys: list, through: int) -> None:
    """Folds all batches up to ``through`` into a snapshot; older folders may be cleared after."""
    running_counts(spark, path, keys, through).write.mode("overwrite").parquet(f"{path}/snapshots/batch={through}")


def upsert_running_counts(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Runs an aggregate over a stream to completion in update mode into ``path``."""
    q = (counts.writeStream.foreachBatch(lambda df, i: put_batch(df, i, path)).outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
