"""Structured Streaming forms of the cascade.

* ``stream_scores``: stateless scoring of a request stream (same ``ScoringBundle.score``
  as batch).
* ``stream_step_matches``: anchors x steps as a stream-stream LEFT OUTER interval join
  (equi key + ``step_ts BETWEEN anchor_ts + lo AND anchor_ts + hi``), both sides
  watermarked, so join state is bounded by the window length plus the allowed delay;
  unmatched anchors are emitted once the watermark passes their window.
* ``stream_window_counts``: watermarked tumbling / sliding event-time counts.

Streams read files (``readStream.parquet``) and write parquet with a checkpoint in the
shared checkpoint folder; ``run_available_now`` drives one to completion (trigger
``availableNow``), which is also how a scheduled incremental job would run it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None,
                      max_files: int | None = None) -> DataFrame:
    """A driver table as a file stream (only that table's file is picked up)."""
    if schema is None:
        schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(sf_dir)


def run_available_now(df: DataFrame, name: str, output_mode: str = "append", at: str | None = None) -> str:
    """Run a streaming plan to completion into parquet; returns the output path.  A run with the
    same folder ``at`` goes on where the last one stopped."""
    spark = df.sparkSession
    out, ck = (f"{at}/out", f"{at}/ckpt") if at else (scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt"))
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode(output_mode).trigger(availableNow=True).queryName(f"{name}_{abs(hash(out)) % 10**8}").start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def stream_step_matches(events: DataFrame, anchor_type: str, step_type: str, lo_days: int, hi_days: int,
                        delay: str = "1 hour", entity: str = "user_id", ts: str = "ts",
                        kind: str = "event_type", event_id: str = "event_id") -> DataFrame:
    """Every anchor event with the step events in its window (left outer)."""
    ev = events.select(event_id, entity, kind, F.col(ts).cast("timestamp").alias(ts))
    a = (ev.where(F.col(kind) == anchor_type)
         .select(F.col(event_id).alias("anchor_id"), F.col(entity).alias("entity_id"),
                 F.col(ts).alias("anchor_ts")).withWatermark("anchor_ts", delay))
    b = (ev.where(F.col(kind) == step_type)
         .select(F.col(event_id).alias("step_id"), F.col(entity).alias("step_entity"),
                 F.col(ts).alias("step_ts")).withWatermark("step_ts", delay))
    cond = ((F.col("entity_id") == F.col("step_entity"))
            # literal intervals: the planner derives the state-eviction bound from them
            & (F.col("step_ts") >= F.col("anchor_ts") + F.expr(f"INTERVAL {int(lo_days)} DAY"))
            & (F.col("step_ts") <= F.col("anchor_ts") + F.expr(f"INTERVAL {int(hi_days)} DAY")))
    return a.join(b, cond, "leftOuter").select("anchor_id", "entity_id", "anchor_ts", "step_id", "step_ts")


def stream_window_counts(events: DataFrame, duration: str = "1 day", slide: str | None = None,
                         delay: str = "1 hour", ts: str = "ts", key: str = "event_type",
                         value: str = "value") -> DataFrame:
    """Per event-time window and key: count and sum, emitted when the watermark
    passes the window end (late rows beyond ``delay`` are dropped)."""
    ev = events.select(F.col(ts).cast("timestamp").alias(ts), key, value).withWatermark(ts, delay)
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    return (ev.groupBy(w.alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                    "n", "total_value"))


def stream_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour", ts: str = "ts",
                    entity: str = "user_id") -> DataFrame:
    """R7 (session windows): activity sessions per entity closed after ``gap`` idle."""
    ev = events.select(F.col(ts).cast("timestamp").alias(ts), entity).withWatermark(ts, delay)
    return (ev.groupBy(F.session_window(ts, gap).alias("s"), entity)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(entity, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n"))


def stream_scores(requests: DataFrame, bundle) -> DataFrame:
    """Scoring is stateless, so the batch function applies to the stream as is."""
    return bundle.score(requests)


def final_watermark(events: DataFrame, ts: str = "ts", delay_seconds: int = 3600):
    """Event-time watermark after a complete run: max event time minus the delay."""
    return events.agg((F.max(F.col(ts).cast("timestamp")) - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(delay_seconds))).alias("wm")).first()["wm"]


def stream_cascade(events: DataFrame, anchor_type: str, spec, delay: str = "1 hour", entity: str = "user_id",
                   ts: str = "ts", kind: str = "event_type", event_id: str = "event_id") -> DataFrame:
    """R6 for a whole cascade: every anchor event joined (left outer) with the step
    events of all the spec's steps inside the widest window ``[min lo, max hi]`` days
    (literal bounds, so join state is evicted by the watermark); each joined row
    carries its step name and whether it falls in that step's own window."""
    lo = min(s.lo for s in spec.steps)
    hi = max(s.hi for s in spec.steps)
    ev = events.select(event_id, entity, kind, F.col(ts).cast("timestamp").alias(ts))
    a = (ev.where(F.col(kind) == anchor_type)
         .select(F.col(event_id).alias("anchor_id"), F.col(entity).alias("entity_id"),
                 F.col(ts).alias("anchor_ts")).withWatermark("anchor_ts", delay))
    b = (ev.where(F.col(kind).isin([s.value for s in spec.steps]))
         .select(F.col(event_id).alias("step_id"), F.col(entity).alias("step_entity"),
                 F.col(kind).alias("step_type"), F.col(ts).alias("step_ts")).withWatermark("step_ts", delay))
    cond = ((F.col("entity_id") == F.col("step_entity"))
            & (F.col("step_ts") >= F.col("anchor_ts") + F.expr(f"INTERVAL {int(lo)} DAY"))
            & (F.col("step_ts") <= F.col("anchor_ts") + F.expr(f"INTERVAL {int(hi)} DAY")))
    j = a.join(b, cond, "leftOuter")
    from ..functions.expressions import floor_days
    d = floor_days(F.col("step_ts"), F.col("anchor_ts"))
    step = F.lit(None).cast("string")
    inw = F.lit(False)
    for s in spec.steps:
        is_s = F.col("step_type") == F.lit(s.value)
        step = F.when(is_s, F.lit(s.name)).otherwise(step)
        inw = inw | (is_s & (d >= F.lit(s.lo)) & (d <= F.lit(s.hi)))
    return j.select("anchor_id", "entity_id", "anchor_ts", "step_id", step.alias("step"), "step_ts",
                    d.alias("days_after_anchor"), F.coalesce(inw, F.lit(False)).alias("in_window"))


def stream_daily_completion(cascade_rows: DataFrame, day: str = "1 day") -> DataFrame:
    """R7 (completion counts): per anchor day and step, the number of matched step
    events and how many fell in their step's window -- a second stateful operator
    chained after the cascade join; the join propagates its watermark downstream, so
    a day is emitted once no later match for its anchors can arrive."""
    return (cascade_rows.groupBy(F.window("anchor_ts", day).alias("w"), "step")
            .agg(F.count("step_id").alias("matched"), F.sum(F.col("in_window").cast("int")).alias("in_window_n"))
            .select(F.col("w.start").alias("day_start"), "step", "matched", "in_window_n"))
