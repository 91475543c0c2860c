"""Feature-availability audit (V1-V3): at which horizon (days after the anchor) can each
feature be known, and which need knowledge of the future.

Feature names are metadata (a few dozen strings); the data work is one aggregate over
the feature table that counts the values of every feature, stacked to long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import CascadeSpec

STEP_SUFFIXES = ("_time_to_update_log", "_time_to_update", "_window_completed", "_missing", "_is_late")


def classify_name(name: str, spec: CascadeSpec):
    """(horizon_day, future_knowledge, category) of one feature name, decided by its
    suffix/prefix (our names; each step's horizon is the end of its window)."""
    hi = {s.name: s.hi for s in spec.steps}
    if name.endswith("_encoded"):
        return 0, False, "demographic"
    if name.endswith("_target_rate"):
        return 0, False, "geographic"
    if name.startswith("anchor_") or name.startswith("years_between"):
        return 0, False, "temporal"
    for suf in STEP_SUFFIXES:
        if name.endswith(suf) and name[: -len(suf)] in hi:
            return hi[name[: -len(suf)]], True, "step"
    if name.startswith("gap_") and "_to_" in name:
        later = name.split("_to_", 1)[1]
        if later in hi:
            return hi[later], True, "gap"
    if name in ("avg_gap_between_updates", "max_gap_between_updates"):
        return max(hi.values()), True, "gap"
    return 0, False, "unknown"


def classify_names(names, spec: CascadeSpec):
    return [(n, *classify_name(n, spec)) for n in sorted(names)]


def availability_table(features: DataFrame, names, spec: CascadeSpec) -> DataFrame:
    """V1 as a table: feature, available_day, future_knowledge, category, n_values."""
    rows = classify_names(names, spec)
    g = features.agg(*[F.count(F.col(n)).alias(f"n{i}") for i, (n, *_) in enumerate(rows)])
    structs = [F.struct(F.lit(n).alias("feature"), F.lit(h).alias("available_day"),
                        F.lit(fk).alias("future_knowledge"), F.lit(cat).alias("category"),
                        F.col(f"n{i}").alias("n_values"))
               for i, (n, h, fk, cat) in enumerate(rows)]
    return g.select(F.inline(F.array(*structs)))


def availability_summary(table: DataFrame, warn_below: float = 50.0) -> DataFrame:
    """V2 + V3: per horizon, the features known by then (cumulative), their share and
    the under-``warn_below``% flag.  Works on the per-feature table (tens of rows)."""
    total = table.count()
    g = table.groupBy(F.col("available_day").alias("horizon")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list("feature").alias("names"))
    w = Window.orderBy("horizon").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per horizon
    cum = g.select("horizon", F.sum("n").over(w).alias("n_features"),
                   F.array_join(F.array_sort(F.flatten(F.collect_list("names").over(w))), ",").alias("features"))
    pct = F.lit(100.0) * F.col("n_features") / F.lit(float(total))
    return cum.select("horizon", F.col("n_features").cast("long"), pct.alias("pct_features"),
                      (F.col("n_features") * F.lit(100.0) / F.lit(float(total)) < F.lit(warn_below)).alias("below_half"),
                      "features")


def feature_profile(features: DataFrame, names, day0_names) -> DataFrame:
    """F16/F21 report: every selected feature, Day-0 membership, mean and count."""
    d0 = set(day0_names)
    g = features.agg(*[x for i, n in enumerate(names)
                       for x in (F.avg(F.col(n).cast("double")).alias(f"m{i}"), F.count(F.col(n)).alias(f"c{i}"))])
    structs = [F.struct(F.lit(n).alias("feature"), F.lit(n in d0).alias("day0"),
                        F.col(f"m{i}").alias("mean_value"), F.col(f"c{i}").alias("n"))
               for i, n in enumerate(names)]
    return g.select(F.inline(F.array(*structs)))


def legacy_availability(names: DataFrame, col: str = "feature") -> DataFrame:
    """V1 parity mode: the reference's ordered substring rules on its own feature names,
    including its two defects (``*_completion_rate`` lands in no horizon; names that
    contain ``dow`` as in ``window`` count as temporal Day-0).

    Output per name: ``day`` (0/30/60/90 or NULL), ``future_knowledge``, ``available``
    (truly available at prediction) and ``category``.
    """
    c = F.col(col)

    def has(*subs):
        cond = F.lit(False)
        for s in subs:
            cond = cond | c.contains(s)
        return cond

    # fixed values: step -> day of the reference's windows
    step_day = [("biometric", 0), ("mobile", 30), ("address", 60), ("name", 90)]

    def by_prefix(marker):
        d = F.lit(None).cast("int")
        for s, day in reversed(step_day):
            d = F.when(F.substring_index(c, marker, 1) == F.lit(s), F.lit(day)).otherwise(d)
        return d

    gap_day = (F.when(c.contains("biometric_to_mobile"), F.lit(30))
               .when(c.contains("mobile_to_address"), F.lit(60))
               .when(c.contains("address_to_name"), F.lit(90))
               .when(has("avg_gap", "max_gap"), F.lit(90)))
    r1 = has("gender", "state", "district", "urban_rural", "encoded")
    r2 = c.contains("completion_rate") & has("state", "district", "urban_rural")
    r3 = has("birthday", "enrolment", "year", "month", "quarter", "dow")
    rule = (F.when(r1, F.lit(1)).when(r2, F.lit(2)).when(r3, F.lit(3))
            .when(c.contains("time_to_update"), F.lit(4)).when(c.contains("window_completed"), F.lit(5))
            .when(c.startswith("gap_") | c.contains("gap"), F.lit(6)).when(c.contains("missing"), F.lit(7))
            .when(c.contains("is_late"), F.lit(8)).otherwise(F.lit(9)))
    r = F.col("__rule")
    day = (F.when((r == 1) & c.contains("_encoded"), F.lit(0)).when(r.isin(2, 3, 9), F.lit(0))
           .when(r == 4, by_prefix("_time_to_update")).when(r == 5, by_prefix("_window_completed"))
           .when(r == 6, gap_day).when(r == 7, by_prefix("_missing")).when(r == 8, by_prefix("_is_late")))
    cat = (F.when((r == 1) & c.contains("_encoded"), F.lit("demographic")).when(r == 2, F.lit("geographic"))
           .when(r == 3, F.lit("temporal")))
    return (names.withColumn("__rule", rule)
            .select(c, day.alias("day"), r.between(4, 8).alias("future_knowledge"),
                    (((r == 1) & c.contains("_encoded")) | r.isin(2, 3)).alias("available"),
                    cat.alias("category")))


def availability_report(table: DataFrame, horizons=None) -> DataFrame:
    """K4: the availability report as one nested row (write it with ``to_json`` /
    ``write.json``): total, per horizon {count, percentage, features}, the
    future-knowledge and truly-available sets, and the categories -- conditional
    aggregates over the per-feature table."""
    hs = horizons or sorted({r[0] for r in table.select("available_day").distinct().collect()})
    total = F.count(F.lit(1))

    def block(cond):
        names = F.array_sort(F.collect_list(F.when(cond, F.col("feature"))))
        n = F.count(F.when(cond, 1))
        return F.struct(n.alias("count"), (F.lit(100.0) * n / total).alias("percentage"), names.alias("features"))

    cols = [total.alias("total_features")]
    cols += [block(F.col("available_day") == F.lit(h)).alias(f"available_at_day{h}") for h in hs]
    cols += [block(F.col("future_knowledge")).alias("requires_future_knowledge"),
             block(~F.col("future_knowledge")).alias("truly_available_at_prediction"),
             F.struct(*[F.array_sort(F.collect_list(F.when(F.col("category") == F.lit(c), F.col("feature"))))
                        .alias(c) for c in ("demographic", "geographic", "temporal")]).alias("categories")]
    return table.agg(*cols)
