"""Streaming queries (R5-R7) driven to completion with ``availableNow`` over the
``events`` table, read back from their parquet sinks.  Emitted rows are compared with
the batch SQL on windows that the final watermark has closed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.tables import table
from ..streaming import keyed as K
from ..streaming import requests as R
from ..streaming import stream as S
from .catalog import register
from .q_cascade import rsql
from .sqlgen import tracked_ctes

DELAY = "1 hour"
DELAY_S = 3600


def _wm_filter_sql(types):
    tl = ", ".join(f"'{t}'" for t in types)
    # global watermark = min over the joined inputs of (max event time - delay)
    return (f"(SELECT min(mx) - INTERVAL {DELAY_S} SECOND FROM "
            f"(SELECT max(ts) AS mx FROM events WHERE event_type IN ({tl}) GROUP BY event_type))")


_MATCH_SQL = f"""
WITH a AS (SELECT event_id AS anchor_id, user_id AS entity_id, ts AS anchor_ts FROM events WHERE event_type = 'signup'),
     b AS (SELECT event_id AS step_id, user_id AS step_entity, ts AS step_ts FROM events WHERE event_type = 'purchase')
SELECT a.anchor_id, a.entity_id, a.anchor_ts, b.step_id, b.step_ts
FROM a LEFT JOIN b ON a.entity_id = b.step_entity AND b.step_ts >= a.anchor_ts
                  AND b.step_ts <= a.anchor_ts + INTERVAL 1 DAY
WHERE a.anchor_ts + INTERVAL 1 DAY < {_wm_filter_sql(('signup', 'purchase'))}"""


@register("stream_cascade_closed", _MATCH_SQL)
def stream_cascade_closed(spark, sf_dir):
    """Stream-stream left outer interval join (signup -> purchase within 1 day),
    both sides watermarked; rows of windows closed by the final watermark."""
    ev = S.read_table_stream(spark, sf_dir, "events")
    out = S.run_available_now(S.stream_step_matches(ev, "signup", "purchase", 0, 1, DELAY), "cascade")
    batch = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase"))
    wm = (batch.groupBy("event_type").agg(F.max(F.col("ts").cast("timestamp")).alias("mx"))
          .agg(F.min("mx")).first()[0])
    r = spark.read.parquet(out)
    closed = F.col("anchor_ts") + F.make_dt_interval(F.lit(1)) < (
        F.lit(wm).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(DELAY_S)))
    return r.where(closed)


_COUNTS_SQL = rsql(f"""
WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, value, ts FROM events)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n,
       sum(value) AS total_value
FROM w GROUP BY 1, 2, 3
HAVING window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL {DELAY_S} SECOND FROM events)""",
                   ["total_value"])


@register("stream_daily_counts", _COUNTS_SQL)
def stream_daily_counts(spark, sf_dir):
    """Watermarked tumbling 1-day counts per event type; closed windows."""
    ev = S.read_table_stream(spark, sf_dir, "events")
    out = S.run_available_now(S.stream_window_counts(ev, "1 day", delay=DELAY), "daily")
    wm = S.final_watermark(table(spark, sf_dir, "events"), delay_seconds=DELAY_S)
    return spark.read.parquet(out).where(F.col("window_end") <= F.lit(wm))


_SLIDING_SQL = rsql(f"""
WITH s AS (SELECT DISTINCT time_bucket(INTERVAL 1 DAY, ts) - INTERVAL (k) DAY AS window_start
           FROM events, range(0, 7) t(k)),
     w AS (SELECT s.window_start, e.event_type, e.value FROM s JOIN events e
           ON e.ts >= s.window_start AND e.ts < s.window_start + INTERVAL 7 DAY)
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, event_type, count(*) AS n,
       sum(value) AS total_value
FROM w GROUP BY 1, 2, 3
HAVING window_start + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL {DELAY_S} SECOND FROM events)""",
                    ["total_value"])


@register("stream_sliding_counts", _SLIDING_SQL)
def stream_sliding_counts(spark, sf_dir):
    """R7 (sliding): 7-day windows every day, watermarked; closed windows."""
    ev = S.read_table_stream(spark, sf_dir, "events")
    out = S.run_available_now(S.stream_window_counts(ev, "7 days", "1 day", delay=DELAY), "sliding")
    wm = S.final_watermark(table(spark, sf_dir, "events"), delay_seconds=DELAY_S)
    return spark.read.parquet(out).where(F.col("window_end") <= F.lit(wm))


_SESSIONS_SQL = f"""
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
     s AS (SELECT user_id, ts,
                  sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
           FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n
FROM s GROUP BY user_id, sid
HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL {DELAY_S} SECOND FROM events)"""


@register("stream_sessions", _SESSIONS_SQL)
def stream_sessions(spark, sf_dir):
    """R7 (session windows): per-user activity sessions (30 min gap), watermarked;
    sessions closed by the final watermark."""
    ev = S.read_table_stream(spark, sf_dir, "events")
    out = S.run_available_now(S.stream_sessions(ev, "30 minutes", DELAY), "sessions")
    wm = S.final_watermark(table(spark, sf_dir, "events"), delay_seconds=DELAY_S)
    return spark.read.parquet(out).where(F.col("session_end") <= F.lit(wm))


@register("stream_score")
def stream_score(spark, sf_dir):
    """The Day-0 scoring bundle applied to a request stream (requests written
    from the customers binding, then streamed file by file)."""
    from ..operators import models as MD
    from ..operators.features import day0_feature_names
    from ..operators.scoring import ScoringBundle
    from .q_cascade import tracked_customers
    from .q_models import model_frame
    f, m = model_frame(spark, sf_dir)
    names = day0_feature_names(m.feature_names)
    bundle = ScoringBundle(m, MD.train_logistic(f.where(F.col("split") == "train"), names, "label"), names, {})
    req_dir = scratch_path(spark, "requests")
    (tracked_customers(spark, sf_dir).select("entity_id", "gender", "state", "district", "urban_rural", "anchor_ts")
     .write.parquet(req_dir))
    schema = spark.read.parquet(req_dir).schema
    reqs = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(req_dir)
    out = S.run_available_now(S.stream_scores(reqs, bundle), "scores")
    return spark.read.parquet(out)


REQUEST_SCHEMA = T.StructType([*(T.StructField(c, T.StringType()) for c in ("entity_id", "gender", "state", "district", "urban_rural")),
                               T.StructField("anchor_ts", T.TimestampType())])


def _requests_sql():
    fields = ("gender", "state", "district", "urban_rural", "anchor_ts")
    whens = " ".join(f"WHEN {c} IS NULL THEN 'Missing required field: {c}'" for c in fields)
    return f"""{tracked_ctes('customers')},
      r AS (SELECT entity_id, gender, state, district, urban_rural, anchor_ts FROM tracked
            UNION SELECT entity_id, gender, state, district, urban_rural, NULL FROM tracked)
      SELECT entity_id, error, error IS NULL AS scored, count(*) AS n
      FROM (SELECT entity_id, CASE {whens} END AS error FROM r) x GROUP BY entity_id, error"""


@register("stream_requests_csv", _requests_sql())
def stream_requests_csv(spark, sf_dir):
    """R5 + S5: every customer as a CSV request in three layouts -- as declared; the same requests again,
    reordered and with one more column; without the anchor -- through the request stream, two files a
    micro-batch: repeats once, refused rows with their error."""
    from ..operators import models as MD
    from ..operators.features import day0_feature_names
    from ..operators.scoring import ScoringBundle
    from .q_cascade import tracked_customers
    from .q_models import model_frame
    f, m = model_frame(spark, sf_dir)
    names = day0_feature_names(m.feature_names)
    bundle = ScoringBundle(m, MD.train_logistic(f.where(F.col("split") == "train"), names, "label"), names, {})
    asked = tracked_customers(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in REQUEST_SCHEMA.names]).checkpoint(eager=True)
    folder, at = scratch_path(spark, "requests"), scratch_path(spark, "requests-scored")
    for part in (asked, asked.select(F.lit("again").alias("note"), *reversed(asked.columns)), asked.drop("anchor_ts")):
        part.write.mode("append").option("header", True).csv(folder)
    scores = R.run(spark, folder, at, REQUEST_SCHEMA, bundle, max_files=2)
    return scores.groupBy(F.col("entity_id").cast("long").alias("entity_id"), "error").agg(
        F.max(F.col("probability").isNotNull()).alias("scored"), F.count(F.lit(1)).alias("n"))


def _steps_sql():
    from ..sources.bindings import USER_SPEC
    spec = USER_SPEC
    lo, hi = min(s.lo for s in spec.steps), max(s.hi for s in spec.steps)
    vals = ", ".join(f"'{s.value}'" for s in spec.steps)
    d = "CAST(floor((epoch_us(b.step_ts) - epoch_us(a.anchor_ts)) / 86400000000.0) AS BIGINT)"
    name = "CASE " + " ".join(f"WHEN b.step_type = '{s.value}' THEN '{s.name}'" for s in spec.steps) + " END"
    inw = " OR ".join(f"(b.step_type = '{s.value}' AND {d} >= {s.lo} AND {d} <= {s.hi})" for s in spec.steps)
    return f"""
WITH a AS (SELECT event_id AS anchor_id, user_id AS entity_id, ts AS anchor_ts FROM events WHERE event_type = 'signup'),
     b AS (SELECT event_id AS step_id, user_id AS step_entity, event_type AS step_type, ts AS step_ts
           FROM events WHERE event_type IN ({vals}))
SELECT a.anchor_id, a.entity_id, a.anchor_ts, b.step_id, {name} AS step, b.step_ts,
       {d} AS days_after_anchor, coalesce({inw}, false) AS in_window
FROM a LEFT JOIN b ON a.entity_id = b.step_entity AND b.step_ts >= a.anchor_ts + INTERVAL {lo} DAY
                  AND b.step_ts <= a.anchor_ts + INTERVAL {hi} DAY
WHERE a.anchor_ts + INTERVAL {hi} DAY < {_wm_filter_sql(('signup', *[s.value for s in spec.steps]))}"""


@register("stream_cascade_steps", _steps_sql())
def stream_cascade_steps(spark, sf_dir):
    """R6 (whole cascade): signups joined as a stream with the view/click/purchase/error
    events of the users spec inside the widest window, with each step's own in-window
    flag; rows of anchors whose widest window the final watermark has closed."""
    from ..sources.bindings import USER_SPEC
    hi = max(s.hi for s in USER_SPEC.steps)
    types = ("signup", *[s.value for s in USER_SPEC.steps])
    ev = S.read_table_stream(spark, sf_dir, "events")
    out = S.run_available_now(S.stream_cascade(ev, "signup", USER_SPEC, DELAY), "cascade-steps")
    batch = table(spark, sf_dir, "events").where(F.col("event_type").isin(*types))
    wm = (batch.groupBy("event_type").agg(F.max(F.col("ts").cast("timestamp")).alias("mx"))
          .agg(F.min("mx")).first()[0])
    closed = F.col("anchor_ts") + F.make_dt_interval(F.lit(hi)) < (
        F.lit(wm).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(DELAY_S)))
    return spark.read.parquet(out).where(closed)


def _completion_sql():
    from ..sources.bindings import USER_SPEC
    hi = max(s.hi for s in USER_SPEC.steps)
    types = ("signup", *[s.value for s in USER_SPEC.steps])
    inner = _steps_sql().split("WHERE a.anchor_ts + INTERVAL")[0]
    return f"""
WITH j AS ({inner})
SELECT time_bucket(INTERVAL 1 DAY, anchor_ts) AS day_start, step, count(step_id) AS matched,
       CAST(sum(CAST(in_window AS INTEGER)) AS BIGINT) AS in_window_n
FROM j GROUP BY 1, 2
HAVING time_bucket(INTERVAL 1 DAY, anchor_ts) + INTERVAL 1 DAY + INTERVAL {hi} DAY <= {_wm_filter_sql(types)}"""


@register("stream_daily_completion", _completion_sql())
def stream_daily_completion(spark, sf_dir):
    """R7 (completion counts): streaming cascade join chained with a watermarked daily
    aggregate -- matched and in-window step events per anchor day and step."""
    from ..sources.bindings import USER_SPEC
    hi = max(s.hi for s in USER_SPEC.steps)
    types = ("signup", *[s.value for s in USER_SPEC.steps])
    ev = S.read_table_stream(spark, sf_dir, "events")
    plan = S.stream_daily_completion(S.stream_cascade(ev, "signup", USER_SPEC, DELAY))
    out = S.run_available_now(plan, "daily-completion")
    batch = table(spark, sf_dir, "events").where(F.col("event_type").isin(*types))
    wm = (batch.groupBy("event_type").agg(F.max(F.col("ts").cast("timestamp")).alias("mx"))
          .agg(F.min("mx")).first()[0])
    closed = F.col("day_start") + F.make_dt_interval(F.lit(1 + hi)) <= (
        F.lit(wm).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(DELAY_S)))
    return spark.read.parquet(out).where(closed)


#: Micro-batches of the keyed-state queries.
SLICES = 4


def _first_steps_sql():
    from ..sources.bindings import USER_SPEC
    types = ("signup", *[s.value for s in USER_SPEC.steps])
    last = max(s.hi for s in USER_SPEC.steps) + 1
    parts = [f"""SELECT a.event_id AS anchor_id, a.user_id AS entity_id, a.ts AS anchor_ts, '{s.name}' AS step,
                        arg_min(b.event_id, (b.ts, b.event_id)) AS step_id, min(b.ts) AS step_ts
                 FROM a LEFT JOIN events b ON b.user_id = a.user_id AND b.event_type = '{s.value}'
                      AND b.ts >= a.ts + INTERVAL {s.lo} DAY AND b.ts < a.ts + INTERVAL {s.hi + 1} DAY
                 GROUP BY a.event_id, a.user_id, a.ts""" for s in USER_SPEC.steps]
    tl = ", ".join(f"'{t}'" for t in types)
    return f"""WITH a AS (SELECT * FROM events WHERE event_type = 'signup' AND ts + INTERVAL {last} DAY <
      (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {DELAY_S} SECOND FROM events WHERE event_type IN ({tl})))
      {' UNION ALL '.join(parts)}"""


@register("stream_first_steps", _first_steps_sql())
def stream_first_steps(spark, sf_dir):
    """R6 as keyed state: the first step event in each step's window of every signup whose windows
    the watermark has closed, over several micro-batches."""
    from ..sources.bindings import USER_SPEC
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    at = scratch_path(spark, "first-steps")
    K.in_slices(events, "ts", SLICES, lambda rows: S.run_available_now(
        K.first_steps(rows, "signup", USER_SPEC, DELAY), "first-steps", at=at))
    return spark.read.parquet(f"{at}/out")


@register("stream_running_counts", rsql("""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS day_start, event_type, count(*) AS n, sum(value) AS total_value
FROM events GROUP BY 1, 2""", ["total_value"]))
def stream_running_counts(spark, sf_dir):
    """R7 in update mode: running counts of every day and event type, upserted micro-batch by
    micro-batch; all rows of the table count, open days too."""
    events = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    path, checkpoint = scratch_path(spark, "running"), scratch_path(spark, "running-ckpt")

    def run(rows):
        counts = rows.withWatermark("ts", DELAY).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"))
        K.upsert_running_counts(counts.select(F.col("w.start").alias("day_start"), "event_type", "n", "total_value"), path, checkpoint)

    K.in_slices(events, "ts", SLICES, run)
    return K.running_counts(spark, path, ["day_start", "event_type"])
