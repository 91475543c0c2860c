"""Bindings of the cascade data model onto the driver tables.

A binding returns ``(entities, step_log, spec)``: entities carry ``entity_id``,
``anchor_ts`` and cohort columns; the step log carries ``entity_id``, ``step_type``,
``step_ts``.  All of them are lazy plans over the parquet tables, so their work grows
with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import md5_uniform, threshold_category
from ..spec import CascadeSpec, StepWindow
from .tables import table

# fixed values: B1 windows (days after a customer's first order) per order priority
CUSTOMER_STEPS = (
    StepWindow("urgent", "1-URGENT", 0, 365),
    StepWindow("high", "2-HIGH", 0, 730),
    StepWindow("medium", "3-MEDIUM", 366, 1460),
    StepWindow("low", "5-LOW", 731, 2190),
)
CUSTOMER_COHORTS = ("state", "district", "segment", "gender", "urban_rural")
CUSTOMER_SPEC = CascadeSpec(steps=CUSTOMER_STEPS, policy="any", mode="days",
                            cohort_cols=CUSTOMER_COHORTS)

# fixed values: B2 windows (days after a user's first event) per event type
USER_STEPS = (
    StepWindow("view", "view", 0, 0),
    StepWindow("click", "click", 1, 2),
    StepWindow("purchase", "purchase", 3, 5),
    StepWindow("error", "error", 0, 5),
)
USER_SPEC = CascadeSpec(steps=USER_STEPS, policy="first", mode="days", cohort_cols=("user_group",))

# fixed values: B3 windows (days between order date and ship date) per return flag
ORDER_STEPS = (
    StepWindow("accepted", "A", 0, 60),
    StepWindow("none", "N", 0, 120),
    StepWindow("returned", "R", 0, 365),
)
ORDER_SPEC = CascadeSpec(steps=ORDER_STEPS, policy="earliest", mode="days",
                         cohort_cols=("o_orderstatus", "o_orderpriority"))

# Threshold that splits customers into the two "area" cohorts (P4 on account balance).
ACCTBAL_URBAN_THRESHOLD = 5000


def customer_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order time per customer (partial + final aggregate, skew-safe)."""
    return (table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("entity_id"))
            .agg(F.min("o_orderdate").cast("timestamp").alias("anchor_ts")))


def customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 entities: every customer, its first-order anchor and cohort columns.

    ``nation``/``region`` are dimension tables; AQE broadcasts them only when their
    measured size is under ``autoBroadcastJoinThreshold`` and sort-merges otherwise.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return (c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
            .join(customer_anchors(spark, sf_dir), c.c_custkey == F.col("entity_id"), "left")
            .select(F.col("c_custkey").alias("entity_id"),
                    F.col("anchor_ts"),
                    F.col("r_name").alias("state"),
                    F.col("n_name").alias("district"),
                    F.col("c_mktsegment").alias("segment"),
                    F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
                    threshold_category(F.col("c_acctbal"), ACCTBAL_URBAN_THRESHOLD, "Urban", "Rural")
                    .alias("urban_rural"),
                    F.col("c_acctbal").alias("acctbal")))


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 step log: one row per order, the step is its priority."""
    return (table(spark, sf_dir, "orders")
            .select(F.col("o_custkey").alias("entity_id"),
                    F.col("o_orderpriority").alias("step_type"),
                    F.col("o_orderdate").cast("timestamp").alias("step_ts")))


def customers(spark: SparkSession, sf_dir: str, spec: CascadeSpec = CUSTOMER_SPEC):
    return customer_entities(spark, sf_dir), customer_log(spark, sf_dir), spec


def users(spark: SparkSession, sf_dir: str, spec: CascadeSpec = USER_SPEC):
    """B2: users of the ``events`` table, anchored at their first event."""
    ev = table(spark, sf_dir, "events")
    ent = (ev.groupBy(F.col("user_id").alias("entity_id"))
           .agg(F.min("ts").cast("timestamp").alias("anchor_ts"))
           .withColumn("user_group", F.concat(F.lit("g"), (F.col("entity_id") % 3).cast("string"))))
    log = ev.select(F.col("user_id").alias("entity_id"), F.col("event_type").alias("step_type"),
                    F.col("ts").cast("timestamp").alias("step_ts"))
    return ent, log, spec


def orders(spark: SparkSession, sf_dir: str, spec: CascadeSpec = ORDER_SPEC):
    """Orders anchored at their order date; line items are the steps (fan-out ~4)."""
    o = table(spark, sf_dir, "orders")
    ent = o.select(F.col("o_orderkey").alias("entity_id"),
                   F.col("o_orderdate").cast("timestamp").alias("anchor_ts"),
                   "o_orderstatus", "o_orderpriority")
    log = (table(spark, sf_dir, "lineitem")
           .select(F.col("l_orderkey").alias("entity_id"), F.col("l_returnflag").alias("step_type"),
                   F.col("l_shipdate").cast("timestamp").alias("step_ts")))
    return ent, log, spec


SCORE_SEED = 7


def scored_customers(spark: SparkSession, sf_dir: str, tracked: DataFrame | None = None) -> DataFrame:
    """B1 label (transition failure) with a deterministic md5 score per customer.

    The score leans on the label for part of the customers so metrics are not trivial:
    score = floor(1000 * (0.6 * u1 + 0.4 * label * u2)) / 1000 with two md5 uniforms
    (three decimals, so many customers share a score: ties are exercised).
    """
    from ..operators.cascade import track
    if tracked is None:
        tracked = track(*customers(spark, sf_dir))
    y = F.col("transition_failure").cast("int")
    u1 = md5_uniform(SCORE_SEED, F.col("entity_id"))
    u2 = md5_uniform(SCORE_SEED + 1, F.col("entity_id"))
    # three decimals by floor (identical IEEE arithmetic in every engine, unlike round)
    score = F.floor((F.lit(0.6) * u1 + F.lit(0.4) * y.cast("double") * u2) * F.lit(1000.0)) / F.lit(1000.0)
    return tracked.select("entity_id", "state", "district", "segment", "gender", "urban_rural",
                          "anchor_ts", y.alias("label"), score.alias("score"))
