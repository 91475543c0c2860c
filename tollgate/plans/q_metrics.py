"""Queries for evaluation metrics, risk bands, fairness, drift and attribution on B5
(customers with the B1 label and a deterministic md5 score)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import metrics as M
from ..sources import bindings as B
from .catalog import register
from .q_cascade import rsql
from .sqlgen import tracked_ctes


def scored(spark, sf_dir):
    return B.scored_customers(spark, sf_dir)


def predicted(spark, sf_dir):
    return M.predictions(scored(spark, sf_dir))


def _u(seed):
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST(entity_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"


SCORED_SQL = f"""{tracked_ctes('customers')},
  scored AS (
    SELECT entity_id, state, district, segment, gender, urban_rural, anchor_ts,
           CAST(transition_failure AS INTEGER) AS label,
           floor((0.6 * {_u(B.SCORE_SEED)} + 0.4 * CAST(CAST(transition_failure AS INTEGER) AS DOUBLE)
                  * {_u(B.SCORE_SEED + 1)}) * 1000.0) / 1000.0 AS score
    FROM tracked),
  pred AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM scored)"""

_COUNTS = """count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS tp,
             count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) AS fp,
             count(CASE WHEN label = 0 AND prediction = 0 THEN 1 END) AS tn,
             count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) AS fn"""


def _div(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


# --------------------------------------------------------------------------- R3
@register("risk_bands", f"""{SCORED_SQL}
  SELECT entity_id, score, prediction,
         CASE WHEN score >= 0.5 THEN 'failure' ELSE 'success' END AS predicted_class,
         CASE WHEN score >= 0.7 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS risk_level
  FROM pred""")
def risk_bands(spark, sf_dir):
    """Decision at 0.5 and risk band (high >= 0.7, medium >= 0.5, else low)."""
    return predicted(spark, sf_dir).select("entity_id", "score", "prediction", "predicted_class", "risk_level")


# --------------------------------------------------------------------------- E1, E2, E9
_BIN_SQL = rsql(f"""{SCORED_SQL},
  c AS (SELECT {_COUNTS}, avg(pow(score - CAST(label AS DOUBLE), 2)) AS brier FROM pred),
  r AS (SELECT *, {_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall FROM c)
  SELECT {_div('tp + tn', 'tp + fp + tn + fn')} AS accuracy, precision, recall,
         coalesce(2.0 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1, brier, tp, fp, tn, fn
  FROM r""", ["accuracy", "precision", "recall", "f1", "brier"])


@register("binary_metrics", _BIN_SQL)
def binary_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1 (zero_division 0), Brier."""
    return M.binary_metrics(predicted(spark, sf_dir))


@register("confusion_matrix", f"""{SCORED_SQL},
  c AS (SELECT {_COUNTS} FROM pred)
  SELECT 0 AS actual, 0 AS predicted, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c
  UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""")
def confusion_matrix(spark, sf_dir):
    """E5: four confusion cells, zero cells included."""
    return M.confusion_matrix(predicted(spark, sf_dir))


def _report_sql():
    def prf(tp, fp, fn):
        p = _div(tp, f"{tp} + {fp}")
        r = _div(tp, f"{tp} + {fn}")
        return p, r, f"coalesce(2.0 * ({p}) * ({r}) / NULLIF(({p}) + ({r}), 0), 0.0)"
    p1, r1, f1 = prf("tp", "fp", "fn")
    p0, r0, f0 = prf("tn", "fn", "fp")
    inner = f"""{SCORED_SQL},
      c AS (SELECT {_COUNTS} FROM pred),
      m AS (SELECT {p0} AS p0, {r0} AS r0, {f0} AS f0, {p1} AS p1, {r1} AS r1, {f1} AS f1,
                   tn + fp AS s0, tp + fn AS s1 FROM c)
      SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m
      UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
      UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM m
      UNION ALL SELECT 'weighted avg', {_div('p0 * s0 + p1 * s1', 's0 + s1')}, {_div('r0 * s0 + r1 * s1', 's0 + s1')},
                       {_div('f0 * s0 + f1 * s1', 's0 + s1')}, s0 + s1 FROM m"""
    return rsql(inner, ["precision", "recall", "f1"])


@register("class_report", _report_sql())
def class_report(spark, sf_dir):
    """Per-class precision/recall/F1/support with macro and weighted averages."""
    return M.class_report(predicted(spark, sf_dir))


# --------------------------------------------------------------------------- E3, E4, E7, E8, E10
_CURVE_SQL = f"""{SCORED_SQL},
  g AS (SELECT score AS threshold, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
        FROM scored WHERE score IS NOT NULL GROUP BY score),
  c AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
               sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
               sum(pos) OVER () AS npos, sum(neg) OVER () AS nneg FROM g)"""


@register("roc_auc", rsql(f"""{_CURVE_SQL},
  a AS (SELECT sum(neg * (cum_pos - pos / 2.0)) AS auc_num,
               sum(pos * (CAST(cum_pos AS DOUBLE) / NULLIF(cum_pos + cum_neg, 0))) AS ap_num,
               max(CASE WHEN CAST(cum_pos AS DOUBLE) / NULLIF(cum_pos + cum_neg, 0) >= 0.8
                        THEN CAST(cum_pos AS DOUBLE) / NULLIF(npos, 0) END) AS r_at_p,
               CAST(first(npos) AS BIGINT) AS npos, CAST(first(nneg) AS BIGINT) AS nneg FROM c)
  SELECT CASE WHEN npos > 0 AND nneg > 0 THEN auc_num / (CAST(npos AS DOUBLE) * CAST(nneg AS DOUBLE)) ELSE 0.5 END
           AS roc_auc,
         {_div('ap_num', 'npos')} AS average_precision, coalesce(r_at_p, 0.0) AS recall_at_precision, npos, nneg
  FROM a""", ["roc_auc", "average_precision", "recall_at_precision"]))
def roc_auc(spark, sf_dir):
    """Exact ROC AUC (ties half), average precision, recall at
    precision >= 0.8 -- distributed running sums, no single-task window."""
    return M.ranking_metrics(scored(spark, sf_dir))


@register("roc_points", rsql(f"""{_CURVE_SQL}
  SELECT threshold, {_div('cum_neg', 'nneg')} AS fpr, {_div('cum_pos', 'npos')} AS tpr FROM c""", ["fpr", "tpr"]))
def roc_points(spark, sf_dir):
    """ROC points at every distinct score."""
    return M.roc_points(scored(spark, sf_dir))


@register("pr_points", rsql(f"""{_CURVE_SQL}
  SELECT threshold, CAST(cum_pos AS DOUBLE) / NULLIF(cum_pos + cum_neg, 0) AS precision,
         {_div('cum_pos', 'npos')} AS recall FROM c
  UNION ALL SELECT NULL::DOUBLE, 1.0, 0.0""", ["precision", "recall"]))
def pr_points(spark, sf_dir):
    """Precision-recall points plus the closing (1, 0) point."""
    return M.pr_points(scored(spark, sf_dir))


# --------------------------------------------------------------------------- E11, E12, M16
@register("calibration_curve", rsql(f"""{SCORED_SQL}
  SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, avg(score) AS mean_score,
         avg(CAST(label AS DOUBLE)) AS observed_rate, count(*) AS n
  FROM scored GROUP BY 1""", ["mean_score", "observed_rate"]))
def calibration_curve(spark, sf_dir):
    """Reliability bins (10 equal-width probability bins)."""
    return M.calibration_curve(scored(spark, sf_dir))


_TOPK = (1, 5, 10, 20)


@register("topk_recall", rsql(f"""{_CURVE_SQL},
  k AS (SELECT *, cum_pos + cum_neg AS cum_n, npos + nneg AS n_all FROM c)
  {' UNION ALL '.join(f"SELECT {k} AS top_pct, {_div(f'min_by(cum_pos, CASE WHEN cum_n >= floor((n_all * {k} + 99) / 100) THEN cum_n END)', 'first(npos)')} AS recall FROM k" for k in _TOPK)}""",
                            ["recall"]))
def topk_recall(spark, sf_dir):
    """Share of positives captured in the top k% by score (ties kept together)."""
    return M.topk_recall(scored(spark, sf_dir), "entity_id", pcts=_TOPK)


_PSI_CUT = "1995-04-01"


@register("psi_drift", rsql(f"""{SCORED_SQL},
  e AS (SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n_expected FROM scored
        WHERE anchor_ts < TIMESTAMP '{_PSI_CUT}' GROUP BY 1),
  a AS (SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n_actual FROM scored
        WHERE anchor_ts >= TIMESTAMP '{_PSI_CUT}' GROUP BY 1),
  j AS (SELECT coalesce(e.bin, a.bin) AS bin, coalesce(n_expected, 0) AS n_expected, coalesce(n_actual, 0) AS n_actual
        FROM e FULL OUTER JOIN a ON e.bin = a.bin),
  p AS (SELECT *, greatest(n_expected / sum(n_expected) OVER (), 0.0001) AS p_expected,
               greatest(n_actual / sum(n_actual) OVER (), 0.0001) AS p_actual FROM j)
  SELECT bin, n_expected, n_actual, p_expected, p_actual, (p_actual - p_expected) * ln(p_actual / p_expected) AS psi
  FROM p""", ["p_expected", "p_actual", "psi"]))
def psi_drift(spark, sf_dir):
    """Population stability of the score between early and later anchors."""
    s = scored(spark, sf_dir)
    cut = F.lit(_PSI_CUT).cast("timestamp")
    return M.psi(s.where(F.col("anchor_ts") < cut), s.where(F.col("anchor_ts") >= cut))


@register("sketch_drift", f"""{SCORED_SQL},
  b AS (SELECT year(anchor_ts) AS period, unnest(range(0, 10)) AS bin, CAST(least(floor(score * 10), 9) AS INTEGER) AS mine FROM scored)
  SELECT CAST(period AS INTEGER) AS period, CAST(bin AS INTEGER) AS bin, count(*) AS n, CAST(count(*) FILTER (WHERE mine = bin) AS BIGINT) AS in_bin,
         true AS within FROM b GROUP BY ALL""")
def sketch_drift(spark, sf_dir):
    """M16 over time: scores by anchor year, counted, and whether each bin's share from the year's
    sketch is within twice the sketch's stated error."""
    s = scored(spark, sf_dir).select(F.year("anchor_ts").alias("period"), "score").checkpoint(eager=True)
    bins = s.groupBy("period", F.least(F.floor(F.col("score") * 10), F.lit(9)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("in_bin"))
    shares = D.bin_shares(D.period_sketches(s, F.col("period"))).alias("a")
    same = F.col("a.period").eqNullSafe(F.col("b.period")) & (F.col("a.bin") == F.col("b.bin"))
    count = F.coalesce("in_bin", F.lit(0))
    return shares.join(bins.alias("b"), same, "left").select(
        "a.period", "a.bin", "n", count.alias("in_bin"), (F.abs(F.col("share") - count / F.col("n")) <= 2 * D.rank_error(4096)).alias("within"))


# --------------------------------------------------------------------------- A13
def _fair_sql():
    parts = []
    for c in ("gender", "state"):
        parts.append(f"SELECT '{c}' AS cohort_type, CAST({c} AS VARCHAR) AS cohort_value, {_COUNTS} "
                     f"FROM pred WHERE {c} IS NOT NULL GROUP BY {c}")
    inner = f"""{SCORED_SQL},
      c AS ({' UNION ALL '.join(parts)})
      SELECT cohort_type, cohort_value, tp + fp + tn + fn AS n, {_div('tp + tn', 'tp + fp + tn + fn')} AS accuracy,
             {_div('tp', 'tp + fn')} AS tpr, {_div('fp', 'fp + tn')} AS fpr, {_div('tp', 'tp + fp')} AS precision
      FROM c"""
    return rsql(inner, ["accuracy", "tpr", "fpr", "precision"])


@register("fairness_by_cohort", _fair_sql())
def fairness_by_cohort(spark, sf_dir):
    """accuracy/TPR/FPR/precision per gender and per region (GROUPING SETS)."""
    return M.fairness_by_cohort(predicted(spark, sf_dir), ["gender", "state"])


# --------------------------------------------------------------------------- M12 linear
# fixed coefficients of an illustrative linear model over three B1 columns
LINEAR_COEFS = (("urgent_days_after_anchor", 0.01), ("high_days_after_anchor", -0.02), ("acctbal", 0.0001))


@register("linear_attribution", rsql(f"""{tracked_ctes('customers')},
  x AS (SELECT entity_id, {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}' for c, _ in LINEAR_COEFS)} FROM tracked),
  m AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c, _ in LINEAR_COEFS)} FROM x)
  {' UNION ALL '.join(f"SELECT entity_id, '{c}' AS feature, {w} * ({c} - m_{c}) AS contribution FROM x, m" for c, w in LINEAR_COEFS)}""",
                                     ["contribution"]))
def linear_attribution(spark, sf_dir):
    """M12 (linear form): exact per-row attribution coef * (x - mean(x))."""
    from ..operators.models import linear_attribution as la
    from .q_cascade import tracked_customers
    t = tracked_customers(spark, sf_dir)
    x = t.select("entity_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c, _ in LINEAR_COEFS])
    return la(x, "entity_id", dict(LINEAR_COEFS))


# --------------------------------------------------------------------------- E13
def _cmp_sql():
    inner = f"""{SCORED_SQL},
      s2 AS (SELECT entity_id, label, score AS s_md5, {_u(B.SCORE_SEED)} AS s_uniform FROM scored),
      long AS (SELECT 'md5_score' AS model, label, s_md5 AS score FROM s2
               UNION ALL SELECT 'uniform', label, s_uniform FROM s2),
      p AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM long)
      SELECT model, {_div('sum(CASE WHEN label = prediction THEN 1 ELSE 0 END)', 'count(*)')} AS accuracy,
             avg(pow(score - label, 2)) AS brier, count(*) AS n FROM p GROUP BY model"""
    return rsql(inner, ["accuracy", "brier"])


@register("model_comparison", _cmp_sql())
def model_comparison(spark, sf_dir):
    """Metrics of several scorers side by side (one grouped aggregate over the
    union of their scored rows)."""
    from ..functions.expressions import md5_uniform
    s = scored(spark, sf_dir)
    long = (s.select(F.lit("md5_score").alias("model"), "label", "score")
            .unionByName(s.select(F.lit("uniform").alias("model"), "label",
                                  md5_uniform(B.SCORE_SEED, F.col("entity_id")).alias("score"))))
    return M.model_comparison(M.predictions(long))


@register("roc_points_sklearn", rsql(f"""{_CURVE_SQL},
  p AS (SELECT threshold, cum_pos AS tp, cum_neg AS fp, npos, nneg,
               row_number() OVER (ORDER BY threshold DESC) AS rk FROM c),
  n AS (SELECT *, lag(tp) OVER (ORDER BY rk) AS tp_p, lead(tp) OVER (ORDER BY rk) AS tp_n,
               lag(fp) OVER (ORDER BY rk) AS fp_p, lead(fp) OVER (ORDER BY rk) AS fp_n FROM p)
  SELECT threshold, {_div('fp', 'nneg')} AS fpr, {_div('tp', 'npos')} AS tpr FROM n
  WHERE tp_p IS NULL OR tp_n IS NULL OR tp_n - 2 * tp + tp_p <> 0 OR fp_n - 2 * fp + fp_p <> 0
  UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0""", ["fpr", "tpr"]))
def roc_points_sklearn(spark, sf_dir):
    """E7 in scikit-learn form: leading (0, 0, +inf) point, collinear points dropped."""
    return M.roc_points(scored(spark, sf_dir), drop_intermediate=True)
