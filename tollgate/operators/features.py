"""Leakage-safe features.

``base_features`` needs no fitting (per-row expressions).  ``fit`` learns lookup
tables from the *training* rows only -- target rates per cohort value, label codes,
scaler moments -- and ``transform`` applies them to any rows with left joins and
column arithmetic.  Lookups are tables keyed by cohort value, written as Parquet to the
shared folder: the planner then knows their bytes and broadcasts a lookup only under
``spark.sql.autoBroadcastJoinThreshold``.  A larger one (a column of very many values) is
joined by shuffle, where no single value can hold much of a lookup; adaptive execution splits
a value that is hot among the rows.  The rates and codes of a column are joined at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import floor_days, inf_to_null, weekday_monday0
from ..functions.ordered import default_buckets, exact_quantiles
from ..spec import CascadeSpec

MISSING_DAYS = 999.0
LATE_DAYS = 90
DEFAULT_RATE = 0.5
UNSEEN_CODE = -1


def base_features(tracked: DataFrame, spec: CascadeSpec, enrol_col: str | None = None,
                  anchor_col: str = "anchor_ts") -> DataFrame:
    """F2-F10 for every step plus gaps and anchor date parts.  Steps whose columns are
    absent (e.g. Day-0 scoring requests) are skipped; ``ensure_parity`` fills them."""
    cols = []
    have = [s for s in spec.steps if f"{s.name}_days_after_anchor" in tracked.columns]
    names = [s.name for s in have]
    for s in have:
        d = F.col(f"{s.name}_days_after_anchor").cast("double")
        t = F.coalesce(d, F.lit(MISSING_DAYS))
        cols += [
            t.alias(f"{s.name}_time_to_update"),
            F.log1p(F.greatest(t, F.lit(0.0))).alias(f"{s.name}_time_to_update_log"),
            F.coalesce(d > F.lit(LATE_DAYS), F.lit(False)).cast("int").alias(f"{s.name}_is_late"),
            window_completed(tracked, s, t).alias(f"{s.name}_window_completed"),
            missing_flag(tracked, s, t).alias(f"{s.name}_missing"),
        ]
    out = tracked.select("*", *cols)
    gaps = []
    for a, b in zip(names, names[1:]):
        g = F.least(F.greatest(F.col(f"{b}_time_to_update") - F.col(f"{a}_time_to_update"),
                               F.lit(-MISSING_DAYS)), F.lit(MISSING_DAYS))
        out = out.withColumn(f"gap_{a}_to_{b}", F.coalesce(g, F.lit(0.0)))
        gaps.append(f"gap_{a}_to_{b}")
    if gaps:
        # P14 + F7: infinities dropped, then the mean / max of the remaining gaps (0 if none)
        arr = F.filter(F.array(*[inf_to_null(F.col(g)) for g in gaps]), lambda x: x.isNotNull())
        out = (out.withColumn("avg_gap_between_updates",
                              F.coalesce(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
                                         / F.size(arr).cast("double"), F.lit(0.0)))
               .withColumn("max_gap_between_updates", F.coalesce(F.array_max(arr), F.lit(0.0))))
    if anchor_col in tracked.columns:
        a = F.col(anchor_col)
        out = (out.withColumn("anchor_year", F.year(a)).withColumn("anchor_month", F.month(a))
               .withColumn("anchor_quarter", F.quarter(a)).withColumn("anchor_dow", weekday_monday0(a)))
        if enrol_col and enrol_col in tracked.columns:
            out = out.withColumn("years_between_enrolment_and_anchor",
                                 floor_days(a, F.col(enrol_col)) / F.lit(365.25))
    return out


def window_completed(df: DataFrame, step, t: Column) -> Column:
    """the tracked in-window flag; without it, C10 on the time to update
    (``t <= hi and t < 999``, lower bound ignored as in the reference)."""
    if f"{step.name}_in_window" in df.columns:
        return F.col(f"{step.name}_in_window").cast("int")
    return ((t <= F.lit(float(step.hi))) & (t < F.lit(MISSING_DAYS))).cast("int")


def missing_flag(df: DataFrame, step, t: Column) -> Column:
    """F8: not updated; without the updated flag, ``t >= 999``."""
    if f"{step.name}_updated" in df.columns:
        return (~F.col(f"{step.name}_updated")).cast("int")
    return (t >= F.lit(MISSING_DAYS)).cast("int")


# fixed values: the reference's excluded identifiers/leak columns and substrings (F16)
EXCLUDE_EXACT = ("entity_id", "dob", "enrolment_date", "anchor_ts", "state", "district", "urban_rural",
                 "gender", "segment", "acctbal", "all_updates_completed", "num_completed_updates",
                 "completion_rate", "num_missing_updates", "days_to_complete_all", "early_completion",
                 "late_completion", "split", "fold", "label", "score", "prediction")
EXCLUDE_PATTERNS = ("_days_after_anchor", "_in_window", "_updated", "_update_ts")


def select_feature_names(columns, target: str = "transition_failure", exclude=EXCLUDE_EXACT,
                         patterns=EXCLUDE_PATTERNS) -> list[str]:
    """F16: drop identifiers, raw categories, the target, leak columns and raw step
    columns; sorted.  Works on column names only (metadata)."""
    out = [c for c in columns
           if c != target and c not in exclude and not any(p in c for p in patterns)]
    return sorted(out)


def day0_feature_names(columns, allow=("_encoded", "_target_rate", "anchor_", "years_between", "pincode"),
                       deny=("time_to_update", "window_completed", "gap", "missing", "is_late")):
    """names matching an allow substring and no deny substring, sorted."""
    return sorted(c for c in columns if any(a in c for a in allow) and not any(d in c for d in deny))


@dataclass
class FeatureModel:
    """Fitted state: lookup tables (DataFrames) and scaler moments (dict)."""

    spec: CascadeSpec
    target: str
    rate_cols: tuple
    code_cols: tuple
    rates: DataFrame | None = None          # (col_name, value, rate)
    codes: DataFrame | None = None          # (col_name, value, code)
    feature_names: list = field(default_factory=list)
    moments: dict = field(default_factory=dict)   # name -> (mean, std_pop)
    medians: dict = field(default_factory=dict)   # name -> training median, of features that can be missing
    null_label: str = "Unknown"
    enrol_col: str | None = None
    lookups: DataFrame | None = None        # (col_name, value, rate, code): rates and codes side by side

    # ------------------------------------------------------------------ fit
    @classmethod
    def fit(cls, train: DataFrame, spec: CascadeSpec, target: str = "transition_failure",
            rate_cols=("state", "district", "urban_rural"),
            code_cols=("gender", "state", "district", "urban_rural"),
            null_label: str = "Unknown", enrol_col: str | None = None, scale: bool = True):
        m = cls(spec, target, tuple(rate_cols), tuple(code_cols), null_label=null_label, enrol_col=enrol_col)
        m.rates = fit_target_rates(train, rate_cols, target)
        m.codes = fit_label_codes(train, code_cols, null_label)
        feats = m._unscaled(train)
        m.feature_names = select_feature_names(feats.columns, target)
        if scale:
            feats = feats.select(*m.feature_names)
            can_miss = [f.name for f in feats.schema if f.nullable]
            m.medians = fit_medians(feats, can_miss) if can_miss else {}
            m.moments = fit_moments(apply_medians(feats, m.medians), m.feature_names)
        return m

    # ------------------------------------------------------------ transform
    def _unscaled(self, df: DataFrame) -> DataFrame:
        out = base_features(df, self.spec, enrol_col=self.enrol_col)
        if self.lookups is None:
            self.lookups = written_lookup(self.rates.join(self.codes, ["col_name", "value"], "full"))
        return apply_lookups(out, self.lookups, self.rate_cols, self.code_cols, self.null_label)

    def transform(self, df: DataFrame, scale: bool = True) -> DataFrame:
        if not self.feature_names:
            raise RuntimeError("FeatureModel is not fitted")
        out = ensure_parity(self._unscaled(df), self.feature_names)
        return self.finish(out, self.feature_names) if scale else out

    def finish(self, df: DataFrame, names) -> DataFrame:
        """F19 + F15 on unscaled features: training medians for missing values, then the
        scaler, so a model matrix holds finite numbers only."""
        out = apply_medians(df, {n: self.medians[n] for n in names if n in self.medians})
        return apply_moments(out, {n: self.moments[n] for n in names if n in self.moments})


def fit_target_rates(train: DataFrame, cols, target: str) -> DataFrame:
    """mean of the target per value of each column, one GROUPING SETS pass.
    (The reference names these ``*_completion_rate`` but they hold the failure rate.)"""
    cols = list(cols)
    g = train.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]).agg(
        F.avg(F.col(target).cast("double")).alias("rate"), F.grouping_id().alias("gid"))
    return written_lookup(_long_from_sets(g, cols, "rate"))


def written_lookup(df: DataFrame) -> DataFrame:
    """Fitted state (one row per value), written once and read by every apply."""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, "lookup")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_lookups(df: DataFrame, lookups: DataFrame, rate_cols, code_cols, null_label: str = "Unknown",
                  default: float = DEFAULT_RATE) -> DataFrame:
    """F12 + F14 / J6 + J7: one left join per column brings its target rate and its code.
    Unseen -> ``default`` and -1; NULL -> ``default`` and the code of ``null_label``."""
    out = df
    for c in dict.fromkeys([*rate_cols, *code_cols]):
        if c not in df.columns:
            continue
        lk = lookups.where(F.col("col_name") == c).select(F.col("value").alias("__v"), F.col("rate").alias("__r"),
                                                          F.col("code").alias("__c"))
        out = out.join(lk, F.coalesce(F.col(c).cast("string"), F.lit(null_label)) == F.col("__v"), "left").drop("__v")
        if c in rate_cols:
            rate = F.when(F.col(c).isNotNull(), F.col("__r"))
            out = out.withColumn(f"{c}_target_rate", F.coalesce(rate, F.lit(default)))
        if c in code_cols:
            out = out.withColumn(f"{c}_encoded", F.coalesce(F.col("__c"), F.lit(UNSEEN_CODE)))
        out = out.drop("__r", "__c")
    return out


def _long_from_sets(g: DataFrame, cols, measure: str) -> DataFrame:
    nb = len(cols)
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(cols):
        gid = (1 << nb) - 1 - (1 << (nb - 1 - i))
        name = F.when(F.col("gid") == gid, F.lit(c)).otherwise(name)
        value = F.when(F.col("gid") == gid, F.col(c).cast("string")).otherwise(value)
    return g.select(name.alias("col_name"), value.alias("value"), F.col(measure)).where(
        F.col("value").isNotNull())


def apply_target_rates(df: DataFrame, rates: DataFrame, cols, default: float = DEFAULT_RATE) -> DataFrame:
    """Left join of the learned rate per value; unseen or NULL -> ``default``."""
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        lk = rates.where(F.col("col_name") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("rate").alias(f"{c}_target_rate"))
        out = (out.join(lk, F.col(c).cast("string") == F.col(f"__v_{c}"), "left").drop(f"__v_{c}")
               .withColumn(f"{c}_target_rate", F.coalesce(F.col(f"{c}_target_rate"), F.lit(default))))
    return out


def fit_label_codes(train: DataFrame, cols, null_label: str = "Unknown") -> DataFrame:
    """sorted distinct values per column -> codes 0..k-1 (NULL becomes
    ``null_label``; the reference's ``astype(str)`` makes it ``'nan'``).

    Codes are distributed ranks, so no task ever holds all values of a column: the
    distinct (column, value) pairs (one GROUPING SETS pass) are range-partitioned,
    ``running_sums`` counts in (column, value) order, and each column's offset (one row
    per column) is subtracted.
    """
    from ..functions.ordered import range_ranks
    cols = list(cols)
    filled = train.select(*[F.coalesce(F.col(c).cast("string"), F.lit(null_label)).alias(c) for c in cols])
    g = filled.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]).agg(
        F.grouping_id().alias("gid"))
    long = _long_from_sets(g.withColumn("one", F.lit(1)), cols, "one").drop("one")
    ranked = range_ranks(long, ["col_name", "value"], "__r", default_buckets(train))
    sizes = sorted((r["col_name"], r["n"]) for r in ranked.groupBy("col_name").agg(
        F.count(F.lit(1)).alias("n")).collect())                      # one row per column
    offset, acc = F.lit(0), 0
    for name, n in sizes:
        offset = F.when(F.col("col_name") == F.lit(name), F.lit(acc)).otherwise(offset)
        acc += n
    return written_lookup(ranked.select("col_name", "value", (F.col("__r") - 1 - offset).cast("int").alias("code")))


def apply_label_codes(df: DataFrame, codes: DataFrame, cols, null_label: str = "Unknown") -> DataFrame:
    """Code per value; values not seen in training -> -1."""
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        lk = codes.where(F.col("col_name") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"{c}_encoded"))
        key = F.coalesce(F.col(c).cast("string"), F.lit(null_label))
        out = (out.join(lk, key == F.col(f"__v_{c}"), "left").drop(f"__v_{c}")
               .withColumn(f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), F.lit(UNSEEN_CODE))))
    return out


def ensure_parity(df: DataFrame, names) -> DataFrame:
    """add absent features with defaults (0.5 for encodings/rates, else 0)."""
    out = df
    for n in names:
        if n not in out.columns:
            dflt = DEFAULT_RATE if ("encoded" in n or "target_rate" in n) else 0.0
            out = out.withColumn(n, F.lit(dflt))
    return out


def fit_moments(df: DataFrame, names) -> dict:
    """F15 fit: mean and *population* std of every feature in one aggregate pass."""
    aggs = []
    for n in names:
        x = F.col(n).cast("double")
        aggs += [F.avg(x).alias(f"m__{n}"), F.stddev_pop(x).alias(f"s__{n}")]
    r = df.agg(*aggs).first()
    return {n: (r[f"m__{n}"], r[f"s__{n}"]) for n in names}


def apply_moments(df: DataFrame, moments: dict) -> DataFrame:
    """F15 apply: (x - mean) / std, std 0 (or undefined) -> divide by 1."""
    def scaled(n, m, s):
        sd = s if (s is not None and s != 0) else 1.0
        return (F.col(n).cast("double") - F.lit(m if m is not None else 0.0)) / F.lit(sd)
    return df.withColumns({n: scaled(n, m, s) for n, (m, s) in moments.items()}) if moments else df


def leakage_correlations(df: DataFrame, names, target: str = "transition_failure",
                         threshold: float = 0.95) -> DataFrame:
    """Pearson correlation of every feature with the target in one aggregate,
    stacked to (feature, corr, abs_corr, flagged)."""
    y = F.col(target).cast("double")
    g = df.agg(*[F.corr(F.col(n).cast("double"), y).alias(f"c{i}") for i, n in enumerate(names)])
    rows = [F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("corr")) for i, n in enumerate(names)]
    return g.select(F.inline(F.array(*rows))).select(
        "feature", "corr", F.abs("corr").alias("abs_corr"),
        F.coalesce(F.abs("corr") > F.lit(threshold), F.lit(False)).alias("flagged"))


def fit_medians(train: DataFrame, cols, exact: bool = True) -> dict:
    """F19 fit: per-column median of the training rows.  ``exact`` uses the distributed
    exact quantile (pandas/DuckDB interpolation); otherwise one ``percentile_approx``
    pass over all columns.  NaN and infinities count as missing."""
    train = train.select(*[inf_to_null(c).alias(c) for c in cols])
    if exact:
        return exact_quantiles(train, cols, 0.5)
    r = train.agg(*[F.percentile_approx(F.col(c), 0.5, 100000).alias(c) for c in cols]).first()
    return {c: r[c] for c in cols}


def apply_medians(df: DataFrame, medians: dict) -> DataFrame:
    """F19 apply: missing (NULL, NaN, infinite) -> training median, then 0 when the median
    itself is NULL."""
    return df.withColumns({c: F.coalesce(inf_to_null(c), F.lit(m).cast("double"), F.lit(0.0)) for c, m in medians.items()
                           if c in df.columns}) if medians else df


def vector_column(df: DataFrame, names, out: str = "features") -> DataFrame:
    """assemble the named columns into an ML vector (``VectorAssembler``)."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="keep").transform(df)


def label_col(target: str = "transition_failure") -> Column:
    return F.col(target).cast("int")


# fixed values: our feature-name parts and the reference's names for them (Q6 parity)
LEGACY_NAME_PARTS = (("_target_rate", "_completion_rate"), ("anchor_", "eighteenth_birthday_"),
                     ("years_between_enrolment_and_anchor", "years_between_enrolment_and_18"))


def legacy_feature_name(name: str) -> str:
    """The reference's name of one of our features (``state_target_rate`` ->
    ``state_completion_rate``, ``anchor_dow`` -> ``eighteenth_birthday_dow``...)."""
    for ours, theirs in LEGACY_NAME_PARTS:
        if name == ours or (ours.endswith("_") and name.startswith(ours)) or name.endswith(ours):
            return name.replace(ours, theirs)
    return name


def with_legacy_names(df: DataFrame, names) -> DataFrame:
    """Rename the feature columns to the reference's names (parity view)."""
    return df.select(*[F.col(c).alias(legacy_feature_name(c)) if c in set(names) else F.col(c)
                       for c in df.columns])
