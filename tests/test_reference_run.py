import os
import tempfile

import simulated_people as simulate

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tollgate.plans import reference_run as RR
from tollgate.sources.tables import table


def _count_csvs(spark, root):
    """The reference's three count folders, derived from the driver tables."""
    o, c, n, r = (table(spark, SF_SMALL, t) for t in ("orders", "customer", "nation", "region"))
    base = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.date_format("o_orderdate", "d-M-yyyy").alias("date"),
                    F.concat(F.lit(" "), F.lower(F.regexp_replace("r_name", " ", "-"))).alias("state"),
                    F.lower("n_name").alias("district"), (F.lit(499990) + F.col("n_nationkey")).cast("long")
                    .alias("pincode"), "o_orderkey"))
    li = table(spark, SF_SMALL, "lineitem")
    enrol = base.groupBy("date", "state", "district", "pincode").agg(F.count(F.lit(1)).alias("age_18_greater"))
    lines = base.join(li, base.o_orderkey == li.l_orderkey)
    bio = lines.groupBy("date", "state", "district", "pincode").agg(F.count(F.lit(1)).alias("bio_age_17_"))
    demo = (lines.where(F.col("l_returnflag") == "R").groupBy("date", "state", "district", "pincode")
            .agg(F.count(F.lit(1)).alias("demo_age_17_")))
    dirs = {}
    for name, df in (("enrol", enrol), ("biometric", bio), ("demographic", demo)):
        d = os.path.join(root, name)
        df.coalesce(2).write.option("header", True).csv(d)
        dirs[name] = d
    return dirs


def test_reference_entry_points_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="tollgate-ref-")
    d = _count_csvs(spark, root)
    out = os.path.join(root, "out")
    from tollgate.sources import files
    counts = [files.split_corrupt(load(spark, d[k]))[0] for load, k in (
        (files.load_enrolment, "enrol"), (files.load_biometric, "biometric"), (files.load_demographic, "demographic"))]
    people = simulate.individuals(RR.counted_adults(*counts), date_col="enrolment_date")
    log = simulate.step_log(people)
    dirs = {}
    for name, df in (
            ("individuals", people.select("gender", F.col("entity_id").alias("aadhaar_id"), F.lit("x").alias("note"), "dob",
                                          "pincode", "district", "state", "enrolment_date", "biometric_updates_count",
                                          "demographic_updates_count")),  # other order, one more column, no area
            ("bio_log", log.where("step_type = 'biometric'").selectExpr("step_ts AS update_date", "entity_id AS aadhaar_id")),
            ("demo_log", log.where("step_type <> 'biometric'").selectExpr(
                "step_type AS update_type", "entity_id AS aadhaar_id", "step_ts AS update_date"))):
        dirs[name] = os.path.join(root, name)
        df.coalesce(2).write.option("header", True).csv(dirs[name])
    with open(os.path.join(dirs["bio_log"], "broken.csv"), "w") as f:
        f.write("update_date,aadhaar_id\nnot a date,7\n")
    res = RR.run_from_folders(spark, dirs["individuals"], dirs["bio_log"], dirs["demo_log"], out, min_size=10,
                              trees=10, gbt_rounds=5)
    corrupt = spark.read.parquet(os.path.join(out, "corrupt_lines")).collect()
    assert [(r["table"], r["line"]) for r in corrupt] == [("biometric_log", "not a date,7")]
    n_orders = table(spark, SF_SMALL, "orders").count()
    assert res["tracked"].count() == n_orders                      # one person per counted unit
    states = {r[0] for r in res["tracked"].select("state").distinct().collect()}
    assert "Middle-East" in states                                 # P3 title case after '-'
    rates = {r["step"]: r["completion_rate_pct"] for r in res["completion_rates"].collect()}
    assert 88 < rates["biometric"] < 100 and 25 < rates["name"] < 55
    assert res["best_model"] == "gbt" and res["metrics"].count() == 3
    from test_audit_entry import REFERENCE_FEATURES
    from tollgate.operators.features import legacy_feature_name
    assert sorted(legacy_feature_name(n) for n in res["feature_model"].feature_names) == sorted(REFERENCE_FEATURES)
    for sub in ("tracked", "completion_rates", "policy_summary", "feature_availability", "model_metrics"):
        assert os.path.isdir(os.path.join(out, sub))
    dep = RR.train_deployment(spark, res["tracked"], out, folds=2)
    assert set(dep["aucs"]) == {"lr", "rf", "gbt"}
    from tollgate.operators.scoring import ScoringBundle
    day0 = ScoringBundle.load(spark, dep["bundle"]).names
    assert len(day0) == 13 and {"pincode", "years_between_enrolment_and_anchor"} <= set(day0)     # F21
    req = (res["tracked"].limit(50).select(F.col("entity_id").alias("aadhaar_id"), "gender", "state", "district",
                                          "urban_rural", F.col("anchor_ts").cast("date").alias("eighteenth_birthday"),
                                          F.col("enrolment_date").cast("date").alias("enrolment_date"), "pincode")
           .withColumn("gender", F.when(F.col("aadhaar_id").endswith("|0"), F.lit(None)).otherwise(F.col("gender"))))
    req_dir = os.path.join(root, "requests")
    req.coalesce(1).write.option("header", True).csv(req_dir)
    scored = RR.score_files(spark, dep["bundle"], req_dir, os.path.join(root, "scored")).collect()
    assert len(scored) == 50
    assert all((r["error"] is None) == (r["probability"] is not None) for r in scored)
    assert any(r["error"] for r in scored) or all(not r["entity_id"].endswith("|0") for r in scored)
    # The same requests as one {"citizens": [...]} JSON document
    import json
    recs = [{k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in r.asDict().items()}
            for r in req.collect()]
    jdir = os.path.join(root, "requests_json")
    os.makedirs(jdir)
    with open(os.path.join(jdir, "batch.json"), "w") as f:
        json.dump({"citizens": recs}, f)
    js = RR.score_files(spark, dep["bundle"], jdir, os.path.join(root, "scored_json"), fmt="json").collect()
    by_id = {r["entity_id"]: r["probability"] for r in scored}
    assert len(js) == 50 and all(by_id[r["entity_id"]] == r["probability"] for r in js)
