import os
import tempfile

from pyspark.sql import functions as F

from tollgate.operators import sinks


def test_sinks_write_tables_and_report(spark):
    d = tempfile.mkdtemp(prefix="tollgate-sink-")
    df = spark.range(20).select(F.col("id"), (F.col("id") % 3).alias("part"))
    sinks.write_table(df, os.path.join(d, "full"), partition_by=["part"])
    assert spark.read.parquet(os.path.join(d, "full")).count() == 20
    sinks.write_small(df, os.path.join(d, "small"))
    assert spark.read.option("header", True).csv(os.path.join(d, "small")).count() == 20
    parts = [sinks.report_rows("s", df.limit(2), "id", ["part"])]
    sinks.write_policy_summary(parts, os.path.join(d, "report"))
    lines = [r[0] for r in spark.read.text(os.path.join(d, "report")).collect()]
    assert len(lines) == 2 and lines[0].startswith("s\t0\t")


def test_policy_summary_sections(spark):
    from conftest import SF_SMALL

    import __spark_entry__ as E
    rows = E.queries()["policy_summary"](spark, SF_SMALL).collect()
    sections = {r["section"] for r in rows}
    assert sections == {"overview", "completion", "tests", "high_risk"}
    assert sum(1 for r in rows if r["section"] == "high_risk") <= 10


def test_policy_report_adds_gaps_to_the_summary(spark):
    from conftest import SF_SMALL

    import __spark_entry__ as E
    rows = E.queries()["policy_report"](spark, SF_SMALL).collect()
    rest = {(r["section"], r["key"], r["value"]) for r in E.queries()["policy_summary"](spark, SF_SMALL).collect()}
    assert rest <= {tuple(r) for r in rows}
    assert {r["section"] for r in rows} - {"gender"} == {"overview", "completion", "tests", "high_risk", "lag"}
    assert all(r["value"] > 5.0 for r in rows if r["section"] == "gender")


def test_markdown_and_nested_availability_report(spark):
    import json

    from tollgate.operators import audit
    from tollgate.sources.bindings import CUSTOMER_SPEC
    d = tempfile.mkdtemp(prefix="tollgate-md-")
    df = spark.createDataFrame([("a", "1.0"), ("b", "2.0")], "key string, value string")
    parts = [df.select(F.lit("sec").alias("section"), "key", "value")]
    sinks.write_markdown(parts, os.path.join(d, "md"))
    lines = [r[0] for r in spark.read.text(os.path.join(d, "md")).collect()]
    assert lines[0] == "# Policy summary" and "## sec" in lines and "| a | 1.0 |" in lines
    names = ["urgent_time_to_update", "state_target_rate", "anchor_dow"]
    feats = spark.createDataFrame([(1.0, 0.5, 2)], "urgent_time_to_update double, state_target_rate double, "
                                                   "anchor_dow int")
    rep = audit.availability_report(audit.availability_table(feats, names, CUSTOMER_SPEC))
    doc = json.loads(rep.toJSON().first())
    assert doc["total_features"] == 3 and doc["available_at_day0"]["count"] == 2
    assert doc["available_at_day365"]["features"] == ["urgent_time_to_update"]
    assert doc["categories"]["geographic"] == ["state_target_rate"]


def test_bucketed_tables_track_without_a_shuffle_of_the_log(spark):
    from conftest import SF_SMALL
    from tollgate.operators.cascade import per_entity_steps
    from tollgate.session import scratch_path
    from tollgate.sources import bindings as B
    ent, log, spec = B.customers(spark, SF_SMALL)
    ent = ent.select("entity_id", "anchor_ts").checkpoint(eager=True)
    hot = log.limit(1).crossJoin(spark.range(3000)).drop("id").withColumn("entity_id", F.lit(1).cast(log.schema["entity_id"].dataType))
    nulls = log.limit(5).withColumn("entity_id", F.lit(None).cast(log.schema["entity_id"].dataType))
    log = log.unionByName(hot).unionByName(nulls).checkpoint(eager=True)
    a, b = (sinks.write_bucketed(t, f"bucketed_{n}", scratch_path(spark, n), "entity_id", 4) for n, t in (("ent", ent), ("log", log)))
    assert sorted(map(str, b.collect())) == sorted(map(str, log.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got, plain = per_entity_steps(a, b, spec), per_entity_steps(ent, log, spec)
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
        empty = sinks.write_bucketed(log.where("1 = 0"), "bucketed_none", scratch_path(spark, "none"), "entity_id", 4)
        assert per_entity_steps(a, empty, spec).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in ("ent", "log", "none"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{n}")
