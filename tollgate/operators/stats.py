"""Cohort statistics over a tracked cascade table.

Every operator is one aggregate pass (conditional sums for all steps and groups at
once) followed by an ``inline`` of a small array of structs to get one row per step.
Results are tiny; the expensive part is a single partial+final aggregate over the
tracked table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import chi2_sf_1dof, safe_div, yates_chi2
from ..functions.ordered import range_ranks
from ..spec import CascadeSpec


def _flag(step: str) -> Column:
    return F.col(f"{step}_in_window").cast("int")


def _pct(num: Column, den: Column) -> Column:
    """num / den * 100, 0 when den is 0 (the reference's guard)."""
    return F.coalesce(safe_div(num, den) * F.lit(100.0), F.lit(0.0))


def completion_rates(tracked: DataFrame, spec: CascadeSpec) -> DataFrame:
    """A1: per step total, completed, completion %, missing, missing %, window label."""
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.coalesce(F.sum(_flag(s.name)), F.lit(0)).alias(f"c_{s.name}") for s in spec.steps]
    g = tracked.agg(*aggs)
    rows = [F.struct(F.lit(s.name).alias("step"), F.lit(s.label).alias("window_days"),
                     F.col("total").alias("total_individuals"),
                     F.col(f"c_{s.name}").cast("long").alias("completed"))
            for s in spec.steps]
    out = g.select(F.inline(F.array(*rows)))
    rate = _pct(F.col("completed"), F.col("total_individuals"))
    return out.select("step", "window_days", "total_individuals", "completed",
                      rate.alias("completion_rate_pct"),
                      (F.col("total_individuals") - F.col("completed")).alias("missing"),
                      (F.lit(100.0) - rate).alias("missing_rate_pct"))


def cohort_completion_rates(tracked: DataFrame, spec: CascadeSpec, cohort: str) -> DataFrame:
    """Completion per (cohort value, step); NULL cohort values are dropped."""
    if cohort not in tracked.columns:
        return tracked.sparkSession.createDataFrame(
            [], "cohort string, step string, total bigint, completed bigint, "
                "completion_rate_pct double, missing bigint")
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.sum(_flag(s.name)).alias(f"c_{s.name}") for s in spec.steps]
    g = tracked.where(F.col(cohort).isNotNull()).groupBy(F.col(cohort).alias("cohort")).agg(*aggs)
    rows = [F.struct(F.lit(s.name).alias("step"), F.col(f"c_{s.name}").cast("long").alias("completed"))
            for s in spec.steps]
    out = g.select("cohort", "total", F.inline(F.array(*rows)))
    return out.select("cohort", "step", "total", "completed",
                      _pct(F.col("completed"), F.col("total")).alias("completion_rate_pct"),
                      (F.col("total") - F.col("completed")).alias("missing"))


def binary_divergence(tracked: DataFrame, spec: CascadeSpec, col: str = "gender",
                      a: str = "M", b: str = "F", names=("male", "female")) -> DataFrame:
    """A3: completion % of group ``a`` and ``b`` per step, absolute and signed gap."""
    na, nb = names
    ga, gb = F.col(col) == F.lit(a), F.col(col) == F.lit(b)
    aggs = [F.count(F.when(ga, 1)).alias("n_a"), F.count(F.when(gb, 1)).alias("n_b")]
    for s in spec.steps:
        aggs += [F.sum(F.when(ga, _flag(s.name))).alias(f"a_{s.name}"),
                 F.sum(F.when(gb, _flag(s.name))).alias(f"b_{s.name}")]
    g = tracked.agg(*aggs)
    rows = [F.struct(F.lit(s.name).alias("step"),
                     _pct(F.col(f"a_{s.name}"), F.col("n_a")).alias("ra"),
                     _pct(F.col(f"b_{s.name}"), F.col("n_b")).alias("rb"))
            for s in spec.steps]
    out = g.select("n_a", "n_b", F.inline(F.array(*rows)))
    return out.select("step",
                      F.col("ra").alias(f"{na}_completion_rate_pct"),
                      F.col("rb").alias(f"{nb}_completion_rate_pct"),
                      F.abs(F.col("ra") - F.col("rb")).alias("divergence_pct_points"),
                      (F.col("ra") - F.col("rb")).alias("relative_divergence"),
                      F.col("n_a").alias(f"{na}_count"), F.col("n_b").alias(f"{nb}_count"))


def area_lag(tracked: DataFrame, spec: CascadeSpec, col: str = "urban_rural",
             urban: str = "Urban", rural: str = "Rural") -> DataFrame:
    """A4: rural minus urban completion %, and rural minus urban mean days over
    in-window rows (0 unless both areas have in-window rows).  Each area is read by
    its own label (fixes the positional read of the reference)."""
    gu, gr = F.col(col) == F.lit(urban), F.col(col) == F.lit(rural)
    aggs = [F.count(F.when(gu, 1)).alias("n_u"), F.count(F.when(gr, 1)).alias("n_r")]
    for s in spec.steps:
        inw, d = F.col(f"{s.name}_in_window"), F.col(f"{s.name}_days_after_anchor")
        aggs += [F.sum(F.when(gu, _flag(s.name))).alias(f"cu_{s.name}"),
                 F.sum(F.when(gr, _flag(s.name))).alias(f"cr_{s.name}"),
                 F.avg(F.when(gu & inw, d)).alias(f"du_{s.name}"),
                 F.avg(F.when(gr & inw, d)).alias(f"dr_{s.name}")]
    g = tracked.agg(*aggs)
    rows = [F.struct(F.lit(s.name).alias("step"),
                     _pct(F.col(f"cu_{s.name}"), F.col("n_u")).alias("ru"),
                     _pct(F.col(f"cr_{s.name}"), F.col("n_r")).alias("rr"),
                     F.col(f"du_{s.name}").alias("du"), F.col(f"dr_{s.name}").alias("dr"))
            for s in spec.steps]
    out = g.select(F.inline(F.array(*rows)))
    return out.select("step",
                      F.col("ru").alias("urban_completion_rate_pct"),
                      F.col("rr").alias("rural_completion_rate_pct"),
                      (F.col("rr") - F.col("ru")).alias("completion_lag_pct_points"),
                      F.col("dr").alias("rural_avg_days_to_update"),
                      F.col("du").alias("urban_avg_days_to_update"),
                      F.coalesce(F.col("dr") - F.col("du"), F.lit(0.0)).alias("lag_days"))


# fixed values: the reference's cohort types and their top-k (None = no limit / no min size)
HIGH_RISK_TYPES = (("state", 10, True), ("district", 20, True), ("gender", None, False),
                   ("urban_rural", None, False))


def high_risk_cohorts(tracked: DataFrame, min_size: int = 100, types=HIGH_RISK_TYPES,
                      target: str = "transition_failure") -> DataFrame:
    """A5: failure rate and size per cohort value for several cohort columns in one
    GROUPING SETS pass (its shuffle is reused by every branch); per type keep rows
    with n >= min_size (when required) and the top-k by rate (ties broken by value).
    Long form (cohort_type, cohort_value, ...)."""
    cols = [t[0] for t in types]
    g = (tracked.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols])
         .agg(F.avg(F.col(target).cast("double")).alias("failure_rate"),
              F.count(F.lit(1)).alias("n"),
              F.grouping_id().alias("gid")))
    nbits = len(cols)
    type_expr, value_expr = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(cols):
        gid_of_c = (1 << nbits) - 1 - (1 << (nbits - 1 - i))
        type_expr = F.when(F.col("gid") == gid_of_c, F.lit(c)).otherwise(type_expr)
        value_expr = F.when(F.col("gid") == gid_of_c, F.col(c).cast("string")).otherwise(value_expr)
    long = (g.select(type_expr.alias("cohort_type"), value_expr.alias("cohort_value"),
                     "failure_rate", "n")
            .where(F.col("cohort_value").isNotNull()))
    # one row per cohort value: write it once so the per-type branches below do not
    # each re-run the GROUPING SETS aggregate over the tracked table
    from ..session import checkpoint_dir
    checkpoint_dir(tracked.sparkSession)
    long = long.checkpoint(eager=True)
    order = [F.desc("failure_rate"), F.asc("cohort_value")]
    w = Window.partitionBy("cohort_type").orderBy(*order)
    parts = []
    for c, k, needs_min in types:
        part = long.where(F.col("cohort_type") == F.lit(c))
        if needs_min:
            part = part.where(F.col("n") >= F.lit(min_size))
        if k is not None:
            # top-k as a sorted limit (per-partition top-k, then a k-row merge): only
            # k rows per type reach the rank window, whatever the column's cardinality
            part = part.orderBy(*order).limit(k).withColumn("rank_in_type", F.row_number().over(w))
        else:
            # uncapped: distributed ranks over range-partitioned rows (any cardinality)
            part = range_ranks(part.withColumn("__nr", -F.col("failure_rate")), ["__nr", "cohort_value"],
                               "rank_in_type").withColumn("rank_in_type", F.col("rank_in_type").cast("int"))
        parts.append(part.select("cohort_type", "cohort_value", "failure_rate", "n", "rank_in_type"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("cohort_type", "cohort_value", "failure_rate", "n", "rank_in_type")


def chi_square_tests(tracked: DataFrame, target: str = "transition_failure",
                     tests=(("gender_failure_chi2", "gender", "M", "F", "Male", "Female"),
                            ("urban_rural_failure_chi2", "urban_rural", "Urban", "Rural", "Urban", "Rural"))
                     ) -> DataFrame:
    """Yates-corrected 2x2 chi-square of failure between two groups, one row per
    test; a test is skipped when one group is empty."""
    y = F.col(target).cast("int")
    aggs = []
    for name, col, a, b, _, _ in tests:
        ga, gb = F.col(col) == F.lit(a), F.col(col) == F.lit(b)
        aggs += [F.count(F.when(ga, 1)).alias(f"{name}_na"), F.sum(F.when(ga, y)).alias(f"{name}_fa"),
                 F.count(F.when(gb, 1)).alias(f"{name}_nb"), F.sum(F.when(gb, y)).alias(f"{name}_fb")]
    g = tracked.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("test"), F.lit(la).alias("la"), F.lit(lb).alias("lb"),
                     F.col(f"{name}_na").alias("na"), F.coalesce(F.col(f"{name}_fa"), F.lit(0)).alias("fa"),
                     F.col(f"{name}_nb").alias("nb"), F.coalesce(F.col(f"{name}_fb"), F.lit(0)).alias("fb"))
            for name, _, _, _, la, lb in tests]
    t = g.select(F.inline(F.array(*rows))).where((F.col("na") > 0) & (F.col("nb") > 0))
    stat = yates_chi2(F.col("fa"), F.col("na") - F.col("fa"), F.col("fb"), F.col("nb") - F.col("fb"))
    t = t.withColumn("statistic", stat).withColumn("p_value", chi2_sf_1dof(F.col("statistic")))
    return t.select("test", "statistic", "p_value", (F.col("p_value") < 0.05).alias("significant"),
                    F.format_string("%s (n=%d)", F.col("la"), F.col("na")).alias("cohort1"),
                    F.format_string("%s (n=%d)", F.col("lb"), F.col("nb")).alias("cohort2"))


def overall_failure_rate(tracked: DataFrame, target: str = "transition_failure") -> DataFrame:
    """Share of entities with at least one missed window."""
    return tracked.agg(F.count(F.lit(1)).alias("n"),
                       F.coalesce(F.avg(F.col(target).cast("double")), F.lit(0.0)).alias("failure_rate"))


def class_balance(df: DataFrame, label: str = "transition_failure") -> DataFrame:
    """A10: rows per label value."""
    return df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def district_risk_grid(tracked: DataFrame, min_size: int = 100, top: int = 20,
                       target: str = "transition_failure") -> DataFrame:
    """Failure rate by (state, district), n >= min_size, top ``top`` by rate, then
    a district x state matrix filled with 0.  The pivot values come from the top-k
    result (at most ``top`` of them), so the pivot never scans for its columns."""
    g = (tracked.where(F.col("state").isNotNull() & F.col("district").isNotNull())
         .groupBy("state", "district")
         .agg(F.avg(F.col(target).cast("double")).alias("failure_rate"), F.count(F.lit(1)).alias("n"))
         .where(F.col("n") >= min_size)
         .orderBy(F.desc("failure_rate"), F.asc("state"), F.asc("district")).limit(top))
    states = sorted(r[0] for r in g.select("state").distinct().collect())
    if not states:
        return g.select("district")
    return (g.groupBy("district").pivot("state", states).agg(F.avg("failure_rate"))
            .na.fill(0.0, subset=states))


def cohort_pivot(cohort_rates: DataFrame, cohorts, value_col: str = "completion_rate_pct",
                 other: str | None = None) -> DataFrame:
    """Step x cohort matrix of a cohort table produced by A2.  The caller names the cohort
    values that become columns; the long form (A2) holds all of them, however many.  ``other`` names
    two more columns: the completion % of all further cohorts together (NULL without any), and
    ``<other>_cohorts``, how many they are."""
    named = [F.first(F.when(F.col("cohort") == F.lit(c), F.col(value_col)), ignorenulls=True).alias(c) for c in cohorts]
    if other:
        rest = ~F.col("cohort").isin(list(cohorts))
        share = _pct(F.sum(F.when(rest, F.col("completed"))), F.sum(F.when(rest, F.col("total"))))
        n = F.count(F.when(rest, 1))
        named += [F.when(n > 0, share).alias(other), n.alias(f"{other}_cohorts")]
    return cohort_rates.groupBy("step").agg(*named)


def wide_risks(risks: DataFrame, types=HIGH_RISK_TYPES) -> DataFrame:
    """The long risk table (A5) with one column per cohort type, NULL in the rows of other types."""
    cols = [F.when(F.col("cohort_type") == F.lit(c), F.col("cohort_value")).alias(c) for c, _, _ in types]
    return risks.select(*cols, "failure_rate", F.col("n").alias("count"), "cohort_type")


#: fixed value: the gap in points beyond which the reference's report names a gender difference
NOTABLE_GAP = 5.0


def gap_lines(tracked: DataFrame, spec: CascadeSpec, gap: float = NOTABLE_GAP) -> list:
    """K5 sections: [steps whose completion differs between the genders by more than ``gap`` points,
    lag of every step between the areas]."""
    gender = binary_divergence(tracked, spec)
    return [gender.where(F.abs("relative_divergence") > F.lit(gap)), area_lag(tracked, spec)]


def wilson_interval(k: Column, n: Column, z: float = 1.959963984540054):
    """95% Wilson score interval of a proportion k/n (NULL when n = 0)."""
    n = n.cast("double")
    p = safe_div(k, n)
    z2 = z * z
    center = (p + F.lit(z2) / (F.lit(2.0) * n)) / (F.lit(1.0) + F.lit(z2) / n)
    half = (F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n + F.lit(z2) / (F.lit(4.0) * n * n))
            / (F.lit(1.0) + F.lit(z2) / n))
    return center - half, center + half


def cohort_effect_sizes(tracked: DataFrame, cohort: str, reference: str,
                        target: str = "transition_failure",
                        measure: str = "days_to_complete_all") -> DataFrame:
    """Per cohort value versus a reference value: failure rate with Wilson 95% CI,
    risk ratio and difference, Cohen's h (rates) and Cohen's d (``measure``)."""
    y = F.col(target).cast("double")
    g = (tracked.where(F.col(cohort).isNotNull())
         .groupBy(F.col(cohort).cast("string").alias("cohort_value"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("failures"),
              F.avg(F.col(measure).cast("double")).alias("m_mean"),
              F.var_samp(F.col(measure).cast("double")).alias("m_var"),
              F.count(F.col(measure)).alias("m_n")))
    # the reference group is one aggregated row: fetch it and use its values as literals
    r = g.where(F.col("cohort_value") == F.lit(reference)).first()
    if r is None:
        raise ValueError(f"reference value {reference!r} not present in {cohort}")
    j = g.select("*", F.lit(r["n"]).alias("ref_n"), F.lit(r["failures"]).alias("ref_failures"),
                 F.lit(r["m_mean"]).cast("double").alias("ref_mean"),
                 F.lit(r["m_var"]).cast("double").alias("ref_var"), F.lit(r["m_n"]).alias("ref_m_n"))
    rate = safe_div(F.col("failures"), F.col("n"))
    ref_rate = safe_div(F.col("ref_failures"), F.col("ref_n"))
    lo, hi = wilson_interval(F.col("failures"), F.col("n"))
    pooled = F.sqrt(safe_div((F.col("m_n") - 1) * F.col("m_var") + (F.col("ref_m_n") - 1) * F.col("ref_var"),
                             F.col("m_n") + F.col("ref_m_n") - 2))
    return j.select(
        "cohort_value", "n", F.col("failures").cast("long").alias("failures"),
        rate.alias("failure_rate"), lo.alias("ci_low"), hi.alias("ci_high"),
        safe_div(rate, ref_rate).alias("risk_ratio"),
        (rate - ref_rate).alias("risk_difference"),
        (F.lit(2.0) * F.asin(F.sqrt(rate)) - F.lit(2.0) * F.asin(F.sqrt(ref_rate))).alias("cohens_h"),
        safe_div(F.col("m_mean") - F.col("ref_mean"), pooled).alias("cohens_d"))


def poisson_cdf(limit: float = 2.0**-32) -> list:
    """P(at most k) of a Poisson(1) draw for k = 0, 1, ... until the rest is below ``limit``."""
    term, total, out = math.exp(-1.0), 0.0, []
    while not out or 1.0 - total >= limit:
        total += term
        out.append(total)
        term /= len(out)
    return out


def bootstrap_intervals(tracked: DataFrame, cohort: str, reference: str, key: str = "entity_id", target: str = "transition_failure",
                        replicates: int = 200, seed: int = 42, level: float = 0.95) -> DataFrame:
    """Percentile intervals of each cohort's failure rate, and of its difference from a
    reference cohort's, by the Poisson bootstrap.

    A row counts Poisson(1) times in a replicate, drawn from a hash of seed, key and replicate (one
    md5 serves four), so any partitioning and any repeated task draws alike.  Replicates are made and
    summed row by row before anything moves: the shuffle holds tasks x cohorts x replicates rows.
    Rows with a NULL cohort or target are left out; a replicate that draws none of a cohort's (or of
    the reference's) rows says nothing of its rate (or difference).  Rows of equal keys draw alike."""
    if replicates < 4 or replicates % 4:
        raise ValueError("replicates come in fours")
    rows = tracked.where(F.col(cohort).isNotNull() & F.col(target).isNotNull()).select(
        F.col(cohort).cast("string").alias("cohort_value"), F.col(target).cast("int").alias("y"),
        F.col(key).cast("string").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(replicates // 4 - 1))).alias("four"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("k", F.lit("")), F.col("four").cast("string")))
    rows = rows.select("cohort_value", "y", "four", digest.alias("digest"))
    draws = [F.struct((F.col("four") * 4 + i).alias("replicate"), (F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("double")
                                                                 / F.lit(2.0**32)).alias("u")) for i in range(4)]
    rows = rows.select("cohort_value", "y", F.inline(F.array(*draws)))
    times = sum(((F.col("u") >= F.lit(t)).cast("int") for t in poisson_cdf()), F.lit(0))
    sums = rows.groupBy("cohort_value", "replicate").agg(F.sum(times).alias("w"), F.sum(times * F.col("y")).alias("s"),
                                                         F.count(F.lit(1)).alias("n"), F.sum("y").alias("failures"))
    rate = safe_div(F.col("s"), F.col("w"))
    ref = F.max(F.when(F.col("cohort_value") == F.lit(reference), rate)).over(Window.partitionBy("replicate"))
    low, high = (1 - level) / 2, (1 + level) / 2
    each = sums.select("cohort_value", "n", "failures", rate.alias("rate"), (rate - ref).alias("difference"))
    return each.groupBy("cohort_value").agg(
        F.max("n").alias("n"), safe_div(F.max("failures"), F.max("n")).alias("failure_rate"),
        F.percentile("rate", low).alias("rate_low"), F.percentile("rate", high).alias("rate_high"),
        F.percentile("difference", low).alias("difference_low"), F.percentile("difference", high).alias("difference_high"))
