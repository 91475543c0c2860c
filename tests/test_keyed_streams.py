import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tollgate.session import scratch_path
from tollgate.spec import CascadeSpec, StepWindow
from tollgate.streaming import keyed as K
from tollgate.streaming import stream as S

SPEC = CascadeSpec(steps=(StepWindow("v", "view", 0, 1), StepWindow("c", "click", 1, 2)), policy="earliest", mode="days", cohort_cols=())
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "event_id long, user_id long, event_type string, ts timestamp"


def brute(rows, closed_before):
    """First step in the window of every anchor closed by then, by trying all events."""
    out = []
    for i, u, k, t in rows:
        if k != "signup" or not t + timedelta(days=3) < closed_before:
            continue
        for s in SPEC.steps:
            inside = [(t2, i2) for i2, u2, k2, t2 in rows if k2 == s.value and u2 is not None and u2 == u
                      and t + timedelta(days=s.lo) <= t2 < t + timedelta(days=s.hi + 1)]
            t2, i2 = min(inside, default=(None, None))
            out.append((i, u, s.name, i2))
    return sorted(out, key=repr)


def one_file_a_batch(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, batches, delay="1 hour", **args):
    path = scratch_path(spark, "events")
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    out = S.run_available_now(K.first_steps(one_file_a_batch(spark, path), "signup", SPEC, delay, **args), "first-steps")
    return sorted(((r["anchor_id"], r["entity_id"], r["step"], r["step_id"]) for r in spark.read.parquet(out).collect()), key=repr)


def events(n, seed, days=12):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = rng.choice([7, 7, 7, 1, 2, 3, None])  # a hot user, and rows without one
        at = START + timedelta(seconds=rng.randrange(days * 86400))
        if i % 10 == 0:  # exactly on the edges of windows
            at = START + timedelta(days=rng.randrange(days))
        rows.append((i, user, rng.choice(["signup", "view", "click", "other"]), at))
    return sorted(rows, key=lambda r: r[3])


def test_micro_batches_equal_brute_force(spark):
    rows = events(400, 1)
    rows.append((9_000, 7, "signup", rows[5][3]))
    rows.append((9_000, 7, "signup", rows[5][3]))  # a repeated anchor
    rows.sort(key=lambda r: r[3])
    mark = max(t for _, _, k, t in rows if k != "other") - timedelta(hours=1)
    want = brute(rows, mark)
    assert len(want) > 50 and any(w[3] is None for w in want) and any(w[3] is not None for w in want)
    shuffled = [rows[i:i + 100] for i in range(0, len(rows), 100)]
    for b in shuffled:
        random.Random(2).shuffle(b)
    assert run(spark, shuffled) == want
    assert run(spark, shuffled, bucket_days=1) == want  # finer buckets, same rows


def test_entities_share_state_keys(spark):
    rng = random.Random(3)
    rows = sorted(((i, rng.choice([*range(40), None]), rng.choice(["signup", "view", "click"]),
                    START + timedelta(seconds=rng.randrange(6 * 86400))) for i in range(500)), key=lambda r: r[3])
    want = brute(rows, rows[-1][3] - timedelta(hours=1))
    assert len(want) > 100
    batches = [rows[:250], rows[250:]]
    assert run(spark, batches, shards=1) == want and run(spark, batches, shards=7) == want
    path = scratch_path(spark, "events")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    at = scratch_path(spark, "shared")
    S.run_available_now(K.first_steps(one_file_a_batch(spark, path), "signup", SPEC, shards=2), "shared", at=at)
    state = spark.read.format("statestore").load(f"{at}/ckpt")
    assert 0 < state.count() <= 2 * 5 + 5  # two shards and the missing entity, not 40 entities, in each open bucket


def test_entities_of_other_types(spark):
    rows = events(200, 6)
    want = brute(rows, max(t for _, _, k, t in rows if k != "other") - timedelta(hours=1))
    path = scratch_path(spark, "events")
    spark.createDataFrame(rows, SCHEMA).withColumn("user_id", F.concat(F.lit("u"), "user_id")).coalesce(1).write.parquet(path)
    out = S.run_available_now(K.first_steps(one_file_a_batch(spark, path), "signup", SPEC), "named")
    got = sorted(((r["anchor_id"], r["entity_id"] and int(r["entity_id"][1:]), r["step"], r["step_id"]) for r in spark.read.parquet(out).collect()), key=repr)
    assert got == want


def test_late_rows_inside_the_delay_count_and_older_ones_are_dropped(spark):
    def at(**k):
        return START + timedelta(**k)
    first = [(1, 1, "signup", at(days=1)), (2, 1, "view", at(days=1, hours=20)), (3, 2, "view", at(days=2))]
    late = [(4, 1, "view", at(days=1, hours=15)),      # 9 hours late: inside the delay of 12
            (5, 2, "view", at(days=4))]
    between = [(10, 2, "view", at(days=4))]            # Spark drops by the watermark that the batch before worked with
    older = [(6, 1, "click", at(days=2, hours=1)),     # that watermark is 3 days 12 hours by now
             (7, 9, "other", at(days=5))]
    end = [(8, 2, "view", at(days=30)), (9, 2, "view", at(days=30))]
    assert run(spark, [first, late, between, older, end], delay="12 hours") == [(1, 1, "c", None), (1, 1, "v", 4)]


def test_running_counts_survive_replay_and_compaction(spark):
    rows = events(300, 4)
    path, table, keys = scratch_path(spark, "in"), scratch_path(spark, "counts"), ["day", "event_type"]
    batches = [rows[i:i + 100] for i in range(0, 300, 100)]
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    counts = (one_file_a_batch(spark, path).withWatermark("ts", "1 day").groupBy(F.window("ts", "1 day").alias("w"), "event_type")
              .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), "event_type", "n"))
    K.upsert_running_counts(counts, table, scratch_path(spark, "ck"))

    def read(through=None):
        return sorted((r["day"], r["event_type"], r["n"]) for r in K.running_counts(spark, table, keys, through).collect())

    def batch(upto):
        seen = spark.createDataFrame([r for b in batches[:upto] for r in b], SCHEMA)
        return sorted((r["day"], r["event_type"], r["count"]) for r in seen.groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").count().collect())

    for i in range(3):
        assert read(i) == batch(i + 1)  # after every micro-batch
    whole = read()
    again = spark.read.parquet(f"{table}/changes/batch=1").checkpoint(eager=True)
    K.put_batch(again, 1, table)        # the batch is delivered twice
    assert read() == whole
    K.compact(spark, table, keys, 1)
    assert read() == whole and read(0) == batch(1)
