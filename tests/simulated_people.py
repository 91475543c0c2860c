"""Made-up people and step logs for the tests.

Test input only: people with birth dates and genders, and a step log of their updates,
drawn by md5 uniforms of (seed, person id), so the same inputs give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.expressions import add_days, md5_uniform

ANCHOR_DAYS = 6570  # 18 x 365


def _u(seed: str, key: Column) -> Column:
    return md5_uniform(seed, key)


def individuals(expanded: DataFrame, date_col: str = "date", key: str = "entity_id") -> DataFrame:
    """C11: per expanded row a birth date ``date - (6570 + U{0..364})`` days, the fixed
    18-year anchor, and a 50/50 gender."""
    k = F.col(key)
    back = F.lit(ANCHOR_DAYS) + F.floor(_u("dob", k) * F.lit(365)).cast("int")
    dob = F.col(date_col).cast("timestamp") - F.make_dt_interval(back)
    return (expanded.withColumn("dob", dob)
            .withColumn("anchor_ts", add_days(F.col("dob"), ANCHOR_DAYS))
            .withColumn("gender", F.when(_u("gender", k) < F.lit(0.5), F.lit("M")).otherwise(F.lit("F"))))


# fixed values: share completing each step and the day range of the simulated event
SIM_STEPS = (("biometric", 0.95, 0, 0), ("mobile", 0.75, 0, 30), ("address", 0.60, 31, 60),
             ("name", 0.40, 61, 90))


def step_log(people: DataFrame, key: str = "entity_id", steps=SIM_STEPS) -> DataFrame:
    """A step log with one event per completed step at ``anchor + U{lo..hi}`` days.
    Biometric and mobile share one completion draw (the reference reuses its seed, so
    mobile completers are a subset of biometric completers)."""
    k = F.col(key)
    shared = _u("completion:biometric", k)
    events = []
    for name, share, lo, hi in steps:
        draw = shared if name in ("biometric", "mobile") else _u(f"completion:{name}", k)
        offset = F.lit(lo) + F.floor(_u(f"offset:{name}", k) * F.lit(hi - lo + 1)).cast("int")
        ts = F.when(draw < F.lit(share), F.col("anchor_ts") + F.make_dt_interval(offset))
        events.append(F.struct(F.lit(name).alias("step_type"), ts.alias("step_ts")))
    return (people.select(k.alias("entity_id"), F.inline(F.array(*events)))
            .where(F.col("step_ts").isNotNull()))
