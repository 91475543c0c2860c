"""The reference's three entry points as Spark jobs over its own input layout.

``run_from_folders``: CSV folders of individuals and of their two update logs -> clean ->
cascade -> statistics -> features -> models -> output files (``run_analysis`` is the same
from DataFrames on).  ``counted_adults``: count CSV folders -> count joins -> one row per
counted adult.  ``train_deployment``: Day-0 calibrated models saved as
bundles.  ``score_files``: score a CSV / JSON request file with a saved bundle.

The driver only sequences distributed jobs; every table stays a DataFrame and every
output goes through a Spark writer.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import python_title, threshold_category
from ..operators import audit, cascade, features as FE, metrics as M, models as MD, prep, scoring
from ..operators import sinks, splits, stats
from ..session import apply_runtime_conf
from ..sources import files
from ..spec import REFERENCE_SPEC

KEYS = ("date", "state", "district", "pincode")
TARGET = "transition_failure"


def counted_adults(enrol: DataFrame, bio: DataFrame, demo: DataFrame,
                   standardise_updates: bool = True) -> DataFrame:
    """P1/P3/P4 + J1/J2 + J9 + P7: one row per counted adult, with update shares.

    ``standardise_updates`` (default) cleans the names of the two update tables like the
    enrolment table so case/spacing differences still join (Q13 fixed); ``False``
    reproduces the reference, which only parses their dates.  Rows whose date does not
    parse stay, with a NULL date.  Read the tables through ``files.split_corrupt`` first."""
    e = prep.clean_counts(enrol)
    names = ("state", "district") if standardise_updates else ()
    b = prep.clean_counts(bio, name_cols=names, pincode_col=None)
    d = prep.clean_counts(demo, name_cols=names, pincode_col=None)
    j = prep.left_join_counts(e, b, KEYS, "bio_age_17_", "biometric_updates")
    j = prep.left_join_counts(j, d, KEYS, "demo_age_17_", "demographic_updates")
    rows = prep.expand_counts(j, "age_18_greater", KEYS)
    return (rows.withColumn("biometric_updates_count", prep.per_unit_rate("biometric_updates", "age_18_greater"))
            .withColumn("demographic_updates_count", prep.per_unit_rate("demographic_updates", "age_18_greater"))
            .withColumnRenamed("date", "enrolment_date"))


def people_table(individuals: DataFrame, as_of: str) -> DataFrame:
    """P3/P4 + C1 + C13: the people of an individuals table as cascade entities.  The anchor is
    18 x 365 days after birth; an absent area follows from the pincode."""
    area = threshold_category(F.col("pincode"), 500000, "Urban", "Rural")
    return (individuals.withColumnRenamed("aadhaar_id", "entity_id")
            .withColumn("state", python_title("state")).withColumn("district", python_title("district"))
            .withColumn("urban_rural", F.coalesce("urban_rural", area))
            .withColumn("anchor_ts", cascade.anchor_plus_days("dob"))
            .withColumn("current_age", cascade.current_age("dob", as_of)))


def step_log_of(biometric_log: DataFrame, demographic_log: DataFrame) -> DataFrame:
    """The two update logs as one step log: biometric updates are one step, demographic
    ones are named by their type (types outside the spec are ignored by tracking)."""
    return (biometric_log.select(F.col("aadhaar_id").alias("entity_id"), F.lit("biometric").alias("step_type"),
                                 F.col("update_date").alias("step_ts"))
            .unionByName(demographic_log.select(F.col("aadhaar_id").alias("entity_id"),
                                                F.lower(F.trim("update_type")).alias("step_type"),
                                                F.col("update_date").alias("step_ts"))))


def run_from_folders(spark: SparkSession, individuals_dir: str, biometric_log_dir: str, demographic_log_dir: str,
                     out_dir: str, as_of: str = "2026-01-01", **options) -> dict:
    """Entry 1 on CSV folders: an individuals table and the two update logs.  Lines that do
    not parse are left out of the analysis and written to ``out_dir/corrupt_lines``."""
    parsed, corrupt = [], []
    for name, df in (("individuals", files.load_individuals(spark, individuals_dir)),
                     ("biometric_log", files.load_biometric_log(spark, biometric_log_dir)),
                     ("demographic_log", files.load_demographic_log(spark, demographic_log_dir))):
        good, bad = files.split_corrupt(df)
        parsed.append(good)
        corrupt.append(bad.select(F.lit(name).alias("table"), F.col("_corrupt").alias("line")))
    sinks.write_table(reduce(DataFrame.unionByName, corrupt), os.path.join(out_dir, "corrupt_lines"))
    return run_analysis(spark, people_table(parsed[0], as_of), step_log_of(*parsed[1:]), out_dir, **options)


def run_analysis(spark: SparkSession, people: DataFrame, step_log: DataFrame, out_dir: str,
                 min_size: int = 100, trees: int = 100, gbt_rounds: int = 100) -> dict:
    """Entry 1 of the reference (full analysis) on entities and their step log, writing its
    outputs under ``out_dir``."""
    apply_runtime_conf(spark)
    ent = people.select("entity_id", "anchor_ts", "enrolment_date", "dob", "state", "district", "pincode",
                        "urban_rural", "gender", "biometric_updates_count", "demographic_updates_count",
                        "current_age")
    tracked = cascade.track(ent, step_log, REFERENCE_SPEC).checkpoint(eager=True)
    sinks.write_table(tracked, os.path.join(out_dir, "tracked"))                              # K1
    out = {
        "completion_rates": stats.completion_rates(tracked, REFERENCE_SPEC),                    # A1
        "gender_divergence": stats.binary_divergence(tracked, REFERENCE_SPEC),                 # A3
        "rural_urban_lag": stats.area_lag(tracked, REFERENCE_SPEC),                            # A4
        "high_risk_cohorts": stats.high_risk_cohorts(tracked, min_size=min_size),              # A5
        "statistical_tests": stats.chi_square_tests(tracked),                                  # A6
    }
    for name, df in out.items():
        sinks.write_small(df, os.path.join(out_dir, name))                                     # K2
    # split before any fit, features fitted on train only
    sp = splits.stratified_split(tracked, "entity_id", TARGET).checkpoint(eager=True)
    train = sp.where(F.col("split") == "train")
    fm = FE.FeatureModel.fit(train, REFERENCE_SPEC, TARGET, enrol_col="enrolment_date")
    feats = fm.transform(sp).withColumn("label", F.col(TARGET).cast("int")).checkpoint(eager=True)
    names = fm.feature_names
    tr, te = feats.where(F.col("split") == "train"), feats.where(F.col("split") == "test")
    fitted = {"lr": MD.train_logistic(tr, names, "label"),
              "rf": MD.train_random_forest(tr, names, "label", numTrees=trees),
              "gbt": MD.train_gbt(tr, names, "label", maxIter=gbt_rounds)}
    metric_rows = []
    for k, m in fitted.items():
        s = M.predictions(MD.score(m, te, names))
        r = M.ranking_metrics(s).first()
        b = M.binary_metrics(s).first()
        metric_rows.append((k, b["accuracy"], b["f1"], r["roc_auc"], r["average_precision"]))
    metrics = spark.createDataFrame(metric_rows, "model string, accuracy double, f1 double, roc_auc double, "
                                                 "average_precision double")
    sinks.write_small(metrics, os.path.join(out_dir, "model_metrics"))
    best = MD.choose_best({k: a for k, _, _, a, _ in metric_rows})                             # M9
    imp = MD.feature_importances(fitted[best], names, spark) if best != "lr" else None
    if imp is not None:
        sinks.write_small(imp, os.path.join(out_dir, f"feature_importance_{best}"))           # K3
    shuffled_train_acc, shuffled_acc, leak = MD.label_shuffle_check(tr, te, names, "label", "entity_id")          # M11
    avail = audit.availability_table(feats, names, REFERENCE_SPEC)
    sinks.write_json_report(audit.availability_report(avail), os.path.join(out_dir, "feature_availability"))  # K4
    overall = stats.overall_failure_rate(tracked)
    gender, lag = stats.gap_lines(tracked, REFERENCE_SPEC)
    parts = [sinks.report_rows("overview", overall, "n", ["failure_rate"]),
             sinks.report_rows("completion", out["completion_rates"], "step", ["completion_rate_pct", "missing_rate_pct", "window_days"]),
             sinks.report_rows("gender", gender, "step", ["divergence_pct_points", "male_completion_rate_pct", "female_completion_rate_pct"]),
             sinks.report_rows("lag", lag, "step", ["completion_lag_pct_points", "urban_completion_rate_pct", "rural_completion_rate_pct"]),
             sinks.report_rows("tests", out["statistical_tests"], "test", ["statistic", "p_value"]),
             sinks.report_rows("models", metrics, "model", ["accuracy", "f1", "roc_auc"]),
             sinks.report_rows("high_risk", out["high_risk_cohorts"].orderBy(F.desc("failure_rate"),
                                                                              "cohort_type", "cohort_value")
                               .limit(10).withColumn("k", F.concat_ws(":", "cohort_type", "cohort_value")),
                               "k", ["failure_rate", "n"])]
    sinks.write_policy_summary(parts, os.path.join(out_dir, "policy_summary"))                # K5
    sinks.write_markdown(parts, os.path.join(out_dir, "policy_summary_md"))
    return {**out, "tracked": tracked, "metrics": metrics, "best_model": best,
            "shuffled_accuracy": shuffled_acc, "shuffled_train_accuracy": shuffled_train_acc, "leakage_warning": leak, "features": feats, "feature_model": fm}


def train_deployment(spark: SparkSession, tracked: DataFrame, out_dir: str, folds: int = 3) -> dict:
    """Entry 2: Day-0 feature set, each of LR / RF / GBT calibrated over ``folds`` folds,
    each saved with its calibration as a scoring bundle, the preferred one named (K7)."""
    sp = splits.stratified_split(tracked, "entity_id", TARGET).checkpoint(eager=True)
    train = sp.where(F.col("split") == "train")
    fm = FE.FeatureModel.fit(train, REFERENCE_SPEC, TARGET, enrol_col="enrolment_date")
    feats = fm.transform(sp).withColumn("label", F.col(TARGET).cast("int")).checkpoint(eager=True)
    names = FE.day0_feature_names(fm.feature_names)
    tr, te = feats.where(F.col("split") == "train"), feats.where(F.col("split") == "test")
    aucs, paths = {}, {}
    for base in ("lr", "rf", "gbt"):
        pairs = MD.fit_calibrated(tr, names, "label", "entity_id", base=base, folds=folds)
        s = MD.score_calibrated(pairs, te.select("entity_id", "label", *names), names, "entity_id")
        aucs[base] = M.ranking_metrics(s).first()["roc_auc"]
        paths[base] = os.path.join(out_dir, "bundles", base)
        scoring.ScoringBundle(fm, None, names, {"model": base, "day0_auc": aucs[base]}, pairs).save(paths[base])
    best = MD.choose_best(aucs)
    return {"aucs": aucs, "best": best, "bundle": paths[best], "bundles": paths}


def score_files(spark: SparkSession, bundle_path: str, input_path: str, output_path: str,
                fmt: str = "csv") -> DataFrame:
    """Entry 3: score a CSV or JSON request file once with a loaded bundle; requests
    carry the 18th birthday as the anchor; invalid rows keep an ``error``."""
    bundle = scoring.ScoringBundle.load(spark, bundle_path)
    reqs = files.score_requests_csv(spark, input_path) if fmt == "csv" else files.score_requests_json(spark,
                                                                                                     input_path)
    reqs = reqs.withColumnRenamed("aadhaar_id", "entity_id").withColumn(
        "anchor_ts", F.col("eighteenth_birthday").cast("timestamp"))
    scored = bundle.score(reqs)
    sinks.write_table(scored, output_path, fmt="csv" if fmt == "csv" else "json")             # K6
    return scored
