"""Queries for features (F2-F22), splits (M1, M2, M11, W6, W7) and the availability
audit (V1-V3) on B1.  Fitting always uses the training split only."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, features as FE, splits
from ..sources import bindings as B
from .catalog import register
from .q_cascade import rsql, tracked_customers
from .sqlgen import floor_days_sql, tracked_ctes

SPEC = B.CUSTOMER_SPEC
SEED = 42
TARGET = "transition_failure"
RATE_COLS = ("state", "district", "urban_rural")
CODE_COLS = ("gender", "state", "district", "urban_rural")


# --------------------------------------------------------------------------- Spark side
def split_customers(spark, sf_dir):
    # the split reads its input three times (class sizes, bucket totals, ranks): write
    # the entity-level tracked table once rather than re-running the cascade over the log
    t = tracked_customers(spark, sf_dir).checkpoint(eager=True)
    return splits.stratified_split(t, "entity_id", TARGET, seed=SEED)


def fitted(spark, sf_dir, enrol_col=None, **kw):
    # the fit reads the training rows several times (rates, codes, moments) and the
    # transform reads all rows: write the split table once to the shared checkpoint
    # folder instead of re-deriving tracking + ranks for every pass
    s = split_customers(spark, sf_dir).checkpoint(eager=True)
    train = s.where(F.col("split") == "train")
    model = FE.FeatureModel.fit(train, SPEC, TARGET, RATE_COLS, CODE_COLS, enrol_col=enrol_col, **kw)
    return s, model


# --------------------------------------------------------------------------- SQL side
def split_sql():
    return f"""{tracked_ctes('customers')},
  split AS (
    SELECT t.*, CASE WHEN row_number() OVER (PARTITION BY transition_failure
                        ORDER BY md5('{SEED}:' || CAST(entity_id AS VARCHAR)))
                      <= floor((count(*) OVER (PARTITION BY transition_failure) * 20 + 99) / 100)
                THEN 'test' ELSE 'train' END AS split
    FROM tracked t)"""


def base_feature_exprs(spec=SPEC, enrol: str | None = None):
    """(name, SQL expression over the tracked table) for the unfitted features."""
    out = []
    names = [s.name for s in spec.steps]
    t = {n: f"coalesce(CAST({n}_days_after_anchor AS DOUBLE), 999.0)" for n in names}
    for n in names:
        out += [(f"{n}_time_to_update", t[n]),
                (f"{n}_time_to_update_log", f"ln(1 + greatest({t[n]}, 0.0))"),
                (f"{n}_is_late", f"CAST(coalesce({n}_days_after_anchor > 90, false) AS INTEGER)"),
                (f"{n}_window_completed", f"CAST({n}_in_window AS INTEGER)"),
                (f"{n}_missing", f"CAST(NOT {n}_updated AS INTEGER)")]
    gaps = []
    for a, b in zip(names, names[1:]):
        g = f"coalesce(least(greatest({t[b]} - {t[a]}, -999.0), 999.0), 0.0)"
        out.append((f"gap_{a}_to_{b}", g))
        gaps.append(g)
    out += [("avg_gap_between_updates", f"({' + '.join(gaps)}) / {float(len(gaps))}"),
            ("max_gap_between_updates", f"greatest({', '.join(gaps)})"),
            ("anchor_year", "CAST(year(anchor_ts) AS INTEGER)"),
            ("anchor_month", "CAST(month(anchor_ts) AS INTEGER)"),
            ("anchor_quarter", "CAST(quarter(anchor_ts) AS INTEGER)"),
            ("anchor_dow", "CAST(isodow(anchor_ts) - 1 AS INTEGER)")]
    if enrol:
        out.append(("years_between_enrolment_and_anchor", f"{floor_days_sql('anchor_ts', enrol)} / 365.25"))
    return out


def fitted_sql():
    """CTEs up to ``feat``: split, unscaled features incl. train-fitted rates and codes."""
    base = ", ".join(f"{e} AS {n}" for n, e in base_feature_exprs())
    rates, codes, rate_sel, code_sel, joins = [], [], [], [], []
    for c in RATE_COLS:
        rates.append(f"""r_{c} AS (SELECT CAST({c} AS VARCHAR) AS v, avg(CAST(transition_failure AS DOUBLE)) AS rate
                 FROM split WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c})""")
        joins.append(f"LEFT JOIN r_{c} ON CAST(b.{c} AS VARCHAR) = r_{c}.v")
        rate_sel.append(f"coalesce(r_{c}.rate, 0.5) AS {c}_target_rate")
    for c in CODE_COLS:
        codes.append(f"""k_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM
                 (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'Unknown') AS v FROM split WHERE split = 'train'))""")
        joins.append(f"LEFT JOIN k_{c} ON coalesce(CAST(b.{c} AS VARCHAR), 'Unknown') = k_{c}.v")
        code_sel.append(f"coalesce(k_{c}.code, -1) AS {c}_encoded")
    return f"""{split_sql()},
  b AS (SELECT *, {base} FROM split),
  {', '.join(rates)},
  {', '.join(codes)},
  feat AS (SELECT b.*, {', '.join(rate_sel + code_sel)} FROM b {' '.join(joins)})"""


def feature_names():
    names = [n for n, _ in base_feature_exprs()]
    names += [f"{c}_target_rate" for c in RATE_COLS] + [f"{c}_encoded" for c in CODE_COLS]
    return sorted(names)


def _q_feature_cols(cols):
    inner = f"{fitted_sql()} SELECT entity_id, {', '.join(cols)} FROM feat"
    return inner


def _double_cols(cols):
    ints = ("_is_late", "_window_completed", "_missing", "_encoded", "anchor_year", "anchor_month",
            "anchor_quarter", "anchor_dow")
    return [c for c in cols if not any(c.endswith(i) or c == i for i in ints)]


def _feature_query(name, cols, doc):
    cols = list(cols)

    def q(spark, sf_dir):
        s, m = fitted(spark, sf_dir, scale=False)
        return m.transform(s, scale=False).select("entity_id", *cols)
    q.__doc__ = doc
    register(name, rsql(_q_feature_cols(cols), _double_cols(cols)))(q)


_STEPS = SPEC.step_names
_feature_query("features_time", [f"{n}_{x}" for n in _STEPS for x in ("time_to_update", "time_to_update_log",
                                                                       "is_late")],
               "F2-F4: time to update (999 when never), log1p, late flag.")
_feature_query("features_windows", [f"{n}_{x}" for n in _STEPS for x in ("window_completed", "missing")],
               "F5, F8: window-completed and missing flags.")
_feature_query("features_gaps", [f"gap_{a}_to_{b}" for a, b in zip(_STEPS, _STEPS[1:])]
               + ["avg_gap_between_updates", "max_gap_between_updates"],
               "F6, F7: clipped step gaps, their mean and max.")
_feature_query("target_encoding", [f"{c}_target_rate" for c in RATE_COLS],
               "F11, F12, J6: train-only target rate per cohort value, unseen -> 0.5.")


def _temporal_sql():
    exprs = dict(base_feature_exprs(enrol="urgent_update_ts"))
    cols = ["anchor_year", "anchor_month", "anchor_quarter", "anchor_dow", "years_between_enrolment_and_anchor"]
    inner = f"{tracked_ctes('customers')} SELECT entity_id, {', '.join(f'{exprs[c]} AS {c}' for c in cols)} FROM tracked"
    return rsql(inner, ["years_between_enrolment_and_anchor"])


@register("features_temporal", _temporal_sql())
def features_temporal(spark, sf_dir):
    """anchor year/month/quarter/Monday-0 weekday and years between an
    enrolment time (here: first urgent order) and the anchor."""
    t = tracked_customers(spark, sf_dir)
    f = FE.base_features(t, SPEC, enrol_col="urgent_update_ts")
    return f.select("entity_id", "anchor_year", "anchor_month", "anchor_quarter", "anchor_dow",
                    "years_between_enrolment_and_anchor")


# --------------------------------------------------------------------------- F13/F14 unseen
_UNSEEN_SQL = f"""{split_sql()},
  k_seg AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM
            (SELECT DISTINCT coalesce(segment, 'Unknown') AS v FROM split
             WHERE split = 'train' AND segment <> 'MACHINERY')),
  k_dis AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM
            (SELECT DISTINCT coalesce(district, 'Unknown') AS v FROM split
             WHERE split = 'train' AND segment <> 'MACHINERY' AND state <> 'ASIA'))
  SELECT s.entity_id, coalesce(k_seg.code, -1) AS segment_encoded, coalesce(k_dis.code, -1) AS district_encoded
  FROM split s LEFT JOIN k_seg ON coalesce(s.segment, 'Unknown') = k_seg.v
  LEFT JOIN k_dis ON coalesce(s.district, 'Unknown') = k_dis.v"""


@register("label_encoding_unseen", _UNSEEN_SQL)
def label_encoding_unseen(spark, sf_dir):
    """Codes fitted on part of the training rows; values never seen
    there (a whole segment, a whole region's districts) encode to -1."""
    s = split_customers(spark, sf_dir)
    train = s.where((F.col("split") == "train") & (F.col("segment") != "MACHINERY"))
    seg = FE.fit_label_codes(train, ["segment"])
    dis = FE.fit_label_codes(train.where(F.col("state") != "ASIA"), ["district"])
    out = FE.apply_label_codes(s, seg, ["segment"])
    out = FE.apply_label_codes(out, dis, ["district"])
    return out.select("entity_id", "segment_encoded", "district_encoded")


# --------------------------------------------------------------------------- F15 scaler
def _scale_sql():
    names = feature_names()
    mom = ", ".join(f"avg(CAST({n} AS DOUBLE)) AS m_{n}, stddev_pop(CAST({n} AS DOUBLE)) AS s_{n}" for n in names)
    sel = ", ".join(f"(CAST(f.{n} AS DOUBLE) - mo.m_{n}) / (CASE WHEN mo.s_{n} IS NULL OR mo.s_{n} = 0 "
                    f"THEN 1.0 ELSE mo.s_{n} END) AS {n}" for n in names)
    meds = ", ".join(f"median(CAST({n} AS DOUBLE)) AS d_{n}" for n in names)
    fill = ", ".join(f"coalesce(CAST(feat.{n} AS DOUBLE), md.d_{n}, 0.0) AS {n}" for n in names)
    inner = f"""{fitted_sql()},
      md AS (SELECT {meds} FROM feat WHERE split = 'train'),
      filled AS (SELECT feat.entity_id, feat.split, {fill} FROM feat, md),
      mo AS (SELECT {mom} FROM filled WHERE split = 'train')
      SELECT f.entity_id, f.split, {sel} FROM filled f, mo"""
    return rsql(inner, names)


@register("standard_scale", _scale_sql())
def standard_scale(spark, sf_dir):
    """The full fitted feature matrix (41-style set), missing values filled
    with the training medians, scaled with train mean and population std (std 0 -> 1)."""
    s, m = fitted(spark, sf_dir)
    return m.transform(s).select("entity_id", "split", *m.feature_names)


# --------------------------------------------------------------------------- F17 parity
_PARITY_SQL = f"""{split_sql()}
  SELECT entity_id, CAST(0.5 AS DOUBLE) AS urban_rural_target_rate, CAST(0.5 AS DOUBLE) AS urban_rural_encoded
  FROM split"""


@register("feature_parity", _PARITY_SQL)
def feature_parity(spark, sf_dir):
    """a scoring frame without ``urban_rural`` still gets every fitted feature;
    encodings and rates of the absent column default to 0.5."""
    s, m = fitted(spark, sf_dir, scale=False)
    out = m.transform(s.drop("urban_rural"), scale=False)
    return out.select("entity_id", F.col("urban_rural_target_rate").cast("double"),
                      F.col("urban_rural_encoded").cast("double"))


# --------------------------------------------------------------------------- F18
def _leak_sql():
    names = feature_names()
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, corr(CAST({n} AS DOUBLE), CAST(transition_failure AS DOUBLE)) AS corr "
        f"FROM feat WHERE split = 'train'" for n in names)
    inner = f"""{fitted_sql()},
      c AS ({parts})
      SELECT feature, corr, abs(corr) AS abs_corr, coalesce(abs(corr) > 0.95, false) AS flagged FROM c"""
    return rsql(inner, ["corr", "abs_corr"])


@register("leakage_correlation", _leak_sql())
def leakage_correlation(spark, sf_dir):
    """Pearson correlation of every derived feature with the target on the
    training rows, flagged above 0.95 (the reference only checked raw columns)."""
    s, m = fitted(spark, sf_dir, scale=False)
    f = m.transform(s.where(F.col("split") == "train"), scale=False)
    return FE.leakage_correlations(f, m.feature_names, TARGET)


# --------------------------------------------------------------------------- F19
_MED_COLS = [f"{n}_days_after_anchor" for n in _STEPS] + ["days_to_complete_all"]


def _median_sql():
    meds = ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in _MED_COLS)
    sel = ", ".join(f"coalesce(CAST(s.{c} AS DOUBLE), md.m_{c}, 0.0) AS {c}" for c in _MED_COLS)
    inner = f"""{split_sql()},
      md AS (SELECT {meds} FROM split WHERE split = 'train')
      SELECT s.entity_id, s.split, {sel} FROM split s, md"""
    return rsql(inner, _MED_COLS)


@register("median_impute", _median_sql())
def median_impute(spark, sf_dir):
    """NULLs filled with the exact *training* median (distributed exact quantile),
    then 0 -- the test rows never contribute to the medians."""
    s = split_customers(spark, sf_dir).checkpoint(eager=True)  # read once per median pass
    med = FE.fit_medians(s.where(F.col("split") == "train"), _MED_COLS, exact=True)
    return FE.apply_medians(s, med).select("entity_id", "split", *_MED_COLS)


# --------------------------------------------------------------------------- M1, M2, W6, W7, M11
@register("stratified_split", f"{split_sql()} SELECT entity_id, transition_failure, split FROM split")
def stratified_split(spark, sf_dir):
    """M1: exact stratified 80/20 split by md5 rank within each class."""
    return split_customers(spark, sf_dir).select("entity_id", TARGET, "split")


_FOLD_SQL = f"""{tracked_ctes('customers')}
  SELECT entity_id, transition_failure,
         CAST((row_number() OVER (PARTITION BY transition_failure
               ORDER BY md5('{SEED}:' || CAST(entity_id AS VARCHAR))) - 1) % 5 AS INTEGER) AS fold
  FROM tracked"""


@register("stratified_folds", _FOLD_SQL)
def stratified_folds(spark, sf_dir):
    """M2: 5 stratified folds (rank in class mod 5)."""
    t = tracked_customers(spark, sf_dir)
    return splits.stratified_folds(t, "entity_id", TARGET, k=5, seed=SEED).select("entity_id", TARGET, "fold")


@register("train_test_union", f"""{split_sql()}
  SELECT entity_id, split, transition_failure FROM split WHERE split = 'train'
  UNION ALL SELECT entity_id, split, transition_failure FROM split WHERE split = 'test'""")
def train_test_union(spark, sf_dir):
    """Train and test parts appended back together (bag union by name)."""
    from ..operators.prep import union_by_name
    s = split_customers(spark, sf_dir).select("entity_id", "split", TARGET)
    return union_by_name([s.where(F.col("split") == "train"), s.where(F.col("split") == "test")])


@register("hash_sample", f"""{tracked_ctes('customers')}
  SELECT entity_id, state, transition_failure FROM tracked
  ORDER BY md5('{SEED}:' || CAST(entity_id AS VARCHAR)), entity_id LIMIT 100""")
def hash_sample(spark, sf_dir):
    """Fixed-size deterministic sample (100 rows by md5 order)."""
    t = tracked_customers(spark, sf_dir).select("entity_id", "state", TARGET)
    return splits.hash_sample(t, "entity_id", 100, seed=SEED)


_SHUFFLE_SQL = f"""{tracked_ctes('customers')},
  a AS (SELECT entity_id, transition_failure,
               row_number() OVER (ORDER BY md5('{SEED}:' || CAST(entity_id AS VARCHAR))) AS r FROM tracked),
  b AS (SELECT transition_failure AS shuffled_label,
               row_number() OVER (ORDER BY md5('{SEED}+1:' || CAST(entity_id AS VARCHAR))) AS r FROM tracked)
  SELECT a.entity_id, a.transition_failure, b.shuffled_label FROM a JOIN b ON a.r = b.r"""


@register("label_shuffle", _SHUFFLE_SQL)
def label_shuffle(spark, sf_dir):
    """M11 pairing step: a deterministic permutation of the labels (equi-join on the
    ranks of two md5 orders)."""
    t = tracked_customers(spark, sf_dir).select("entity_id", TARGET)
    return splits.shuffled_labels(t, "entity_id", TARGET, seed=SEED)


# --------------------------------------------------------------------------- F16, F21, V1-V3
# What the audit must say of each feature of the customers binding, written out (the steps'
# windows end on days 365, 730, 1460 and 2190): features, day, future knowledge, category.
EXPECTED_AUDIT = (
    ("anchor_dow anchor_month anchor_quarter anchor_year", 0, False, "temporal"),
    ("district_encoded gender_encoded state_encoded urban_rural_encoded", 0, False, "demographic"),
    ("district_target_rate state_target_rate urban_rural_target_rate", 0, False, "geographic"),
    ("urgent_is_late urgent_missing urgent_time_to_update urgent_time_to_update_log urgent_window_completed",
     365, True, "step"),
    ("high_is_late high_missing high_time_to_update high_time_to_update_log high_window_completed", 730, True, "step"),
    ("medium_is_late medium_missing medium_time_to_update medium_time_to_update_log medium_window_completed",
     1460, True, "step"),
    ("low_is_late low_missing low_time_to_update low_time_to_update_log low_window_completed", 2190, True, "step"),
    ("gap_urgent_to_high", 730, True, "gap"),
    ("gap_high_to_medium", 1460, True, "gap"),
    ("gap_medium_to_low avg_gap_between_updates max_gap_between_updates", 2190, True, "gap"),
)
EXPECTED_DAY0 = """anchor_dow anchor_month anchor_quarter anchor_year district_encoded district_target_rate
gender_encoded state_encoded state_target_rate urban_rural_encoded urban_rural_target_rate""".split()


def _expected_audit():
    return sorted((n, day, future, cat) for names, day, future, cat in EXPECTED_AUDIT for n in names.split())


def _selection_sql():
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {str(n in EXPECTED_DAY0).lower()} AS day0, avg(CAST({n} AS DOUBLE)) AS mean_value, "
        f"count({n}) AS n FROM feat" for n, *_ in _expected_audit())
    return rsql(f"{fitted_sql()} {parts}", ["mean_value"])


@register("feature_selection", _selection_sql())
def feature_selection(spark, sf_dir):
    """F16 + F21: the selected feature names of the fitted table, whether each is a
    Day-0 feature, and its mean / count over all rows (one aggregate, stacked)."""
    s, m = fitted(spark, sf_dir, scale=False)
    f = m.transform(s, scale=False)
    return audit.feature_profile(f, m.feature_names, FE.day0_feature_names(m.feature_names))


def _audit_sql():
    rows = _expected_audit()
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {h} AS available_day, {str(fk).lower()} AS future_knowledge, "
        f"'{cat}' AS category, count({n}) AS n_values FROM feat"
        for n, h, fk, cat in rows)
    return f"{fitted_sql()} {parts}"


@register("availability_audit", _audit_sql())
def availability_audit(spark, sf_dir):
    """V1: horizon (day a feature can be known), future-knowledge flag and category of
    every fitted feature, with its value count over the feature table."""
    s, m = fitted(spark, sf_dir, scale=False)
    f = m.transform(s, scale=False)
    return audit.availability_table(f, m.feature_names, SPEC)


def _audit_summary_sql():
    rows = _expected_audit()
    vals = " UNION ALL ".join(f"SELECT '{n}' AS feature, {h} AS available_day, count({n}) AS n_values FROM feat"
                              for n, h, fk, cat in rows)
    inner = f"""{fitted_sql()},
      a AS ({vals}),
      h AS (SELECT DISTINCT available_day AS horizon FROM a)
      SELECT h.horizon, CAST(count(a.feature) AS BIGINT) AS n_features,
             100.0 * count(a.feature) / {len(rows)} AS pct_features,
             count(a.feature) * 100.0 / {len(rows)} < 50.0 AS below_half,
             string_agg(a.feature, ',' ORDER BY a.feature) AS features
      FROM h JOIN a ON a.available_day <= h.horizon GROUP BY h.horizon"""
    return rsql(inner, ["pct_features"])


@register("availability_summary", _audit_summary_sql())
def availability_summary(spark, sf_dir):
    """V2 + V3: per horizon the features known by then (cumulative), share and the
    under-50% warning flag; lists are sorted, comma-joined."""
    s, m = fitted(spark, sf_dir, scale=False)
    f = m.transform(s, scale=False)
    return audit.availability_summary(audit.availability_table(f, m.feature_names, SPEC))



# --------------------------------------------------------------------------- F5/F8 fallbacks
def _fallback_sql():
    cols = []
    for st in SPEC.steps:
        t = f"coalesce(CAST({st.name}_days_after_anchor AS DOUBLE), 999.0)"
        cols += [f"CAST(({t} <= {float(st.hi)}) AND ({t} < 999.0) AS INTEGER) AS {st.name}_window_completed",
                 f"CAST({t} >= 999.0 AS INTEGER) AS {st.name}_missing"]
    return f"{tracked_ctes('customers')} SELECT entity_id, {', '.join(cols)} FROM tracked"


@register("features_missing", _fallback_sql())
def features_missing(spark, sf_dir):
    """F5 + F8 fallbacks: window-completed and missing flags derived from day counts
    alone when the tracked in-window / updated flags are not available."""
    t = tracked_customers(spark, sf_dir)
    drop = [c for c in t.columns if c.endswith("_in_window") or c.endswith("_updated")]
    f = FE.base_features(t.drop(*drop), SPEC)
    return f.select("entity_id", *[f"{st.name}_{x}" for st in SPEC.steps for x in ("window_completed", "missing")])
