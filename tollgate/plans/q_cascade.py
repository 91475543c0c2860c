"""Queries for the cascade core (C1-C13, J5) and cohort statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cascade, stats
from ..sources import bindings as B
from ..sources.tables import table
from .catalog import register
from .sqlgen import floor_days_sql, pct_sql, tracked_ctes, tracked_select_list

MIN_SIZE = 50  # B1 cohorts are ~300 (region) and 43-74 (nation) customers at sf0.01


def rsql(inner: str, cols) -> str:
    """Wrap oracle SQL so that the listed double columns are rounded to 6 digits."""
    if not cols:
        return inner
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) q"


def tracked_customers(spark, sf_dir):
    return cascade.track(*B.customers(spark, sf_dir))


# --------------------------------------------------------------------------- A1
def _a1_sql():
    spec = B.CUSTOMER_SPEC
    parts = []
    for s in spec.steps:
        parts.append(f"""SELECT '{s.name}' AS step, '{s.label}' AS window_days,
              count(*) AS total_individuals,
              CAST(coalesce(sum(CAST({s.name}_in_window AS INTEGER)), 0) AS BIGINT) AS completed
            FROM tracked""")
    body = " UNION ALL ".join(parts)
    inner = f"""{tracked_ctes('customers')}
    SELECT step, window_days, total_individuals, completed,
           {pct_sql('completed', 'total_individuals')} AS completion_rate_pct,
           total_individuals - completed AS missing,
           100.0 - {pct_sql('completed', 'total_individuals')} AS missing_rate_pct
    FROM ({body}) x"""
    return rsql(inner, ["completion_rate_pct", "missing_rate_pct"])


@register("cascade_completion_rates", _a1_sql())
def cascade_completion_rates(spark, sf_dir):
    """C2-C8 + A1 on B1 (customers, order priorities, `any` policy)."""
    return stats.completion_rates(tracked_customers(spark, sf_dir), B.CUSTOMER_SPEC)


# --------------------------------------------------------------------------- tracked tables
def _tracked_q(binding, extra):
    spec = {"customers": B.CUSTOMER_SPEC, "users": B.USER_SPEC, "orders": B.ORDER_SPEC}[binding]
    return f"{tracked_ctes(binding)} SELECT {tracked_select_list(spec, extra)} FROM tracked"


@register("cascade_tracked_any", _tracked_q("customers", ("state", "district", "segment", "gender",
                                                          "urban_rural")))
def cascade_tracked_any(spark, sf_dir):
    """J5 `any` policy, C3-C8: full tracked table of B1."""
    t = tracked_customers(spark, sf_dir)
    return t.select(tracked_select_cols(B.CUSTOMER_SPEC, ("state", "district", "segment", "gender",
                                                           "urban_rural")))


def tracked_select_cols(spec, extra=()):
    cols = ["entity_id", "anchor_ts", *extra]
    for s in spec.steps:
        cols += [f"{s.name}_updated", f"{s.name}_update_ts", f"{s.name}_days_after_anchor",
                 f"{s.name}_in_window"]
    return cols + ["transition_failure", "days_to_complete_all"]


@register("cascade_tracked_first", _tracked_q("users", ("user_group",)))
def cascade_tracked_first(spark, sf_dir):
    """J5 `first` policy on B2 (users, event types, real times of day -> floor days)."""
    ent, log, spec = B.users(spark, sf_dir)
    return cascade.track(ent, log, spec).select(tracked_select_cols(spec, ("user_group",)))


@register("cascade_negative_lag_days", _tracked_q("orders", ("o_orderstatus", "o_orderpriority")))
def cascade_negative_lag_days(spark, sf_dir):
    """J5 `earliest` policy on B3 (orders -> line items): negative lags, missing steps."""
    ent, log, spec = B.orders(spark, sf_dir)
    return cascade.track(ent, log, spec).select(
        tracked_select_cols(spec, ("o_orderstatus", "o_orderpriority")))


def _ts_mode_sql():
    from .sqlgen import tracked_ctes as tc
    spec = B.USER_SPEC.with_(mode="timestamp", policy="any")
    return f"{tc('users', spec)} SELECT {tracked_select_list(spec, ('user_group',))} FROM tracked"


@register("cascade_timestamp_mode", _ts_mode_sql())
def cascade_timestamp_mode(spark, sf_dir):
    """C3 at timestamp precision (`anchor + lo days <= ts <= anchor + hi days`), `any`."""
    spec = B.USER_SPEC.with_(mode="timestamp", policy="any")
    ent, log, _ = B.users(spark, sf_dir)
    return cascade.track(ent, log, spec).select(tracked_select_cols(spec, ("user_group",)))


# --------------------------------------------------------------------------- C1, C9, C10, C13
_ANCHOR_SQL = f"""
SELECT o_orderkey AS entity_id,
       o_orderdate + INTERVAL 6570 DAY AS anchor_fixed,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 216 MONTH AS TIMESTAMP) AS anchor_calendar,
       round({floor_days_sql("TIMESTAMP '2026-01-01 00:00:00'", 'o_orderdate')} / 365.25, 6) AS current_age,
       {floor_days_sql('l.first_ship', 'o_orderdate')} AS ship_days,
       coalesce({floor_days_sql('l.first_ship', 'o_orderdate')} <= 30
                AND {floor_days_sql('l.first_ship', 'o_orderdate')} < 999, false) AS window_hi_only,
       coalesce({floor_days_sql('l.first_ship', 'o_orderdate')} <= 30
                AND {floor_days_sql('l.first_ship', 'o_orderdate')} < 999
                AND {floor_days_sql('l.first_ship', 'o_orderdate')} >= 10, false) AS window_strict
FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey"""


@register("anchor_fixed_days", _ANCHOR_SQL)
def anchor_fixed_days(spark, sf_dir):
    """C1 (fixed 6570 days and calendar variant), C13 (age at a fixed date),
    C4 + C10 (window from a day count only, with and without the lower bound)."""
    from ..functions.expressions import floor_days
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("dob"))
    first = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.min(F.col("l_shipdate").cast("timestamp")).alias("first_ship")))
    j = o.join(first, o.o_orderkey == first.l_orderkey, "left")
    j = j.withColumn("ship_days", floor_days(F.col("first_ship"), F.col("dob")))
    return j.select(
        F.col("o_orderkey").alias("entity_id"),
        cascade.anchor_plus_days("dob").alias("anchor_fixed"),
        cascade.anchor_plus_days("dob", calendar=True).alias("anchor_calendar"),
        cascade.current_age("dob", "2026-01-01").alias("current_age"),
        "ship_days",
        cascade.window_from_days("ship_days", hi=30).alias("window_hi_only"),
        cascade.window_from_days("ship_days", hi=30, lo=10).alias("window_strict"))


# --------------------------------------------------------------------------- A2
def _a2_sql(cohort):
    spec = B.CUSTOMER_SPEC
    parts = [f"""SELECT {cohort} AS cohort, '{s.name}' AS step, count(*) AS total,
                 CAST(sum(CAST({s.name}_in_window AS INTEGER)) AS BIGINT) AS completed
               FROM tracked WHERE {cohort} IS NOT NULL GROUP BY {cohort}""" for s in spec.steps]
    inner = f"""{tracked_ctes('customers')}
      SELECT cohort, step, total, completed, {pct_sql('completed', 'total')} AS completion_rate_pct,
             total - completed AS missing
      FROM ({' UNION ALL '.join(parts)}) x"""
    return rsql(inner, ["completion_rate_pct"])


for _name, _col in (("cohort_completion_region", "state"), ("cohort_completion_segment", "segment"),
                    ("cohort_completion_area", "urban_rural")):
    def _mk(col):
        def q(spark, sf_dir):
            """Completion per cohort value and step."""
            return stats.cohort_completion_rates(tracked_customers(spark, sf_dir), B.CUSTOMER_SPEC, col)
        return q
    register(_name, _a2_sql(_col))(_mk(_col))


# --------------------------------------------------------------------------- A3
def _a3_sql():
    parts = []
    for s in B.CUSTOMER_SPEC.steps:
        parts.append(f"""SELECT '{s.name}' AS step,
            count(CASE WHEN gender = 'M' THEN 1 END) AS n_a, count(CASE WHEN gender = 'F' THEN 1 END) AS n_b,
            sum(CASE WHEN gender = 'M' THEN CAST({s.name}_in_window AS INTEGER) END) AS c_a,
            sum(CASE WHEN gender = 'F' THEN CAST({s.name}_in_window AS INTEGER) END) AS c_b
          FROM tracked""")
    inner = f"""{tracked_ctes('customers')}
      SELECT step, ra AS male_completion_rate_pct, rb AS female_completion_rate_pct,
             abs(ra - rb) AS divergence_pct_points, ra - rb AS relative_divergence,
             n_a AS male_count, n_b AS female_count
      FROM (SELECT step, n_a, n_b, {pct_sql('c_a', 'n_a')} AS ra, {pct_sql('c_b', 'n_b')} AS rb
            FROM ({' UNION ALL '.join(parts)}) x) y"""
    return rsql(inner, ["male_completion_rate_pct", "female_completion_rate_pct",
                        "divergence_pct_points", "relative_divergence"])


@register("binary_cohort_divergence", _a3_sql())
def binary_cohort_divergence(spark, sf_dir):
    """A3: completion gap between two groups of a binary cohort (gender-like)."""
    return stats.binary_divergence(tracked_customers(spark, sf_dir), B.CUSTOMER_SPEC)


# --------------------------------------------------------------------------- A4
def _a4_sql():
    parts = []
    for s in B.CUSTOMER_SPEC.steps:
        w, d = f"{s.name}_in_window", f"{s.name}_days_after_anchor"
        parts.append(f"""SELECT '{s.name}' AS step,
            count(CASE WHEN urban_rural = 'Urban' THEN 1 END) AS n_u,
            count(CASE WHEN urban_rural = 'Rural' THEN 1 END) AS n_r,
            sum(CASE WHEN urban_rural = 'Urban' THEN CAST({w} AS INTEGER) END) AS c_u,
            sum(CASE WHEN urban_rural = 'Rural' THEN CAST({w} AS INTEGER) END) AS c_r,
            avg(CASE WHEN urban_rural = 'Urban' AND {w} THEN {d} END) AS du,
            avg(CASE WHEN urban_rural = 'Rural' AND {w} THEN {d} END) AS dr
          FROM tracked""")
    inner = f"""{tracked_ctes('customers')}
      SELECT step, ru AS urban_completion_rate_pct, rr AS rural_completion_rate_pct,
             rr - ru AS completion_lag_pct_points, dr AS rural_avg_days_to_update,
             du AS urban_avg_days_to_update, coalesce(dr - du, 0.0) AS lag_days
      FROM (SELECT step, {pct_sql('c_u', 'n_u')} AS ru, {pct_sql('c_r', 'n_r')} AS rr, du, dr
            FROM ({' UNION ALL '.join(parts)}) x) y"""
    return rsql(inner, ["urban_completion_rate_pct", "rural_completion_rate_pct",
                        "completion_lag_pct_points", "rural_avg_days_to_update",
                        "urban_avg_days_to_update", "lag_days"])


@register("area_lag", _a4_sql())
def area_lag(spark, sf_dir):
    """A4: rural-urban completion lag and in-window day lag."""
    return stats.area_lag(tracked_customers(spark, sf_dir), B.CUSTOMER_SPEC)


# --------------------------------------------------------------------------- A5
def _a5_sql(min_size=MIN_SIZE):
    parts = [f"""SELECT '{c}' AS cohort_type, CAST({c} AS VARCHAR) AS cohort_value,
                  avg(CAST(transition_failure AS DOUBLE)) AS failure_rate, count(*) AS n
                FROM tracked WHERE {c} IS NOT NULL GROUP BY {c}"""
             for c, _, _ in stats.HIGH_RISK_TYPES]
    keep = " OR ".join(
        f"(cohort_type = '{c}'{f' AND n >= {min_size}' if m else ''})" for c, _, m in stats.HIGH_RISK_TYPES)
    lim = " AND ".join(f"NOT (cohort_type = '{c}' AND rank_in_type > {k})"
                       for c, k, _ in stats.HIGH_RISK_TYPES if k is not None)
    inner = f"""{tracked_ctes('customers')},
      g AS ({' UNION ALL '.join(parts)}),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY cohort_type
                         ORDER BY failure_rate DESC, cohort_value ASC) AS INTEGER) AS rank_in_type
            FROM g WHERE {keep})
      SELECT cohort_type, cohort_value, failure_rate, n, rank_in_type FROM r WHERE {lim}"""
    return rsql(inner, ["failure_rate"])


@register("high_risk_cohorts", _a5_sql())
def high_risk_cohorts(spark, sf_dir):
    """A5 + W1/W2/W4/W5: GROUPING SETS over four cohort columns, size filter, top-k."""
    return stats.high_risk_cohorts(tracked_customers(spark, sf_dir), min_size=MIN_SIZE)


def _wide_sql():
    cols = ", ".join(f"CASE WHEN cohort_type = '{c}' THEN cohort_value END AS {c}" for c, _, _ in stats.HIGH_RISK_TYPES)
    return f"SELECT {cols}, failure_rate, n AS count, cohort_type FROM ({_a5_sql(100)}) r"


@register("high_risk_cohorts_wide", _wide_sql())
def high_risk_cohorts_wide(spark, sf_dir):
    """A5 + W5 as the reference lays them out: a column per cohort type, its size floor of 100."""
    return stats.wide_risks(stats.high_risk_cohorts(tracked_customers(spark, sf_dir), min_size=100))


# --------------------------------------------------------------------------- A6
def _a6_sql():
    from .sqlgen import tracked_ctes as tc

    def chi(name, col, a, b, la, lb):
        return f"""SELECT '{name}' AS test, '{la}' AS la, '{lb}' AS lb,
            count(CASE WHEN {col} = '{a}' THEN 1 END) AS na,
            coalesce(sum(CASE WHEN {col} = '{a}' THEN CAST(transition_failure AS INTEGER) END), 0) AS fa,
            count(CASE WHEN {col} = '{b}' THEN 1 END) AS nb,
            coalesce(sum(CASE WHEN {col} = '{b}' THEN CAST(transition_failure AS INTEGER) END), 0) AS fb
          FROM tracked"""
    t = (f"{chi('gender_failure_chi2', 'gender', 'M', 'F', 'Male', 'Female')} UNION ALL "
         f"{chi('urban_rural_failure_chi2', 'urban_rural', 'Urban', 'Rural', 'Urban', 'Rural')}")
    # Yates-corrected 2x2 statistic; its upper tail by the midpoint rule on the integral of
    # exp(-x / (2 sin(t)^2)) over t in (0, pi/2), times 2/pi
    inner = f"""{tc('customers')},
      t AS ({t}),
      c AS (SELECT *, CAST(fa AS DOUBLE) AS a, CAST(na - fa AS DOUBLE) AS b, CAST(fb AS DOUBLE) AS c2,
                   CAST(nb - fb AS DOUBLE) AS d FROM t WHERE na > 0 AND nb > 0),
      s AS (SELECT *, CASE WHEN (a + b) * (c2 + d) * (a + c2) * (b + d) > 0 THEN
                 (a + b + c2 + d) * pow(greatest(abs(a * d - b * c2) - (a + b + c2 + d) / 2.0, 0.0), 2)
                 / ((a + b) * (c2 + d) * (a + c2) * (b + d)) ELSE 0.0 END AS statistic FROM c),
      q AS (SELECT *, list_avg([exp(-statistic / (2.0 * pow(sin((k + 0.5) * pi() / 40000.0), 2)))
                                for k in range(20000)]) AS p_value FROM s)
      SELECT test, statistic, p_value, p_value < 0.05 AS significant,
             la || ' (n=' || CAST(na AS VARCHAR) || ')' AS cohort1,
             lb || ' (n=' || CAST(nb AS VARCHAR) || ')' AS cohort2
      FROM q"""
    return rsql(inner, ["statistic", "p_value"])


@register("cohort_chi_square", _a6_sql())
def cohort_chi_square(spark, sf_dir):
    """Yates 2x2 chi-square of failure by gender and by area."""
    return stats.chi_square_tests(tracked_customers(spark, sf_dir))


# --------------------------------------------------------------------------- A7, A10
@register("overall_failure_rate", rsql(
    f"{tracked_ctes('customers')} SELECT count(*) AS n, "
    "coalesce(avg(CAST(transition_failure AS DOUBLE)), 0.0) AS failure_rate FROM tracked",
    ["failure_rate"]))
def overall_failure_rate(spark, sf_dir):
    """Overall failure rate."""
    return stats.overall_failure_rate(tracked_customers(spark, sf_dir))


@register("class_balance", f"{tracked_ctes('customers')} SELECT CAST(transition_failure AS INTEGER) AS label, "
                           "count(*) AS n FROM tracked GROUP BY 1")
def class_balance(spark, sf_dir):
    """A10: label counts."""
    return stats.class_balance(tracked_customers(spark, sf_dir))


# --------------------------------------------------------------------------- A8, A9
def _a8_sql():
    states = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    cols = ", ".join(f"coalesce(max(CASE WHEN state = '{s}' THEN failure_rate END), 0.0) AS \"{s}\""
                     for s in states)
    inner = f"""{tracked_ctes('customers')},
      g AS (SELECT state, district, avg(CAST(transition_failure AS DOUBLE)) AS failure_rate, count(*) AS n
            FROM tracked WHERE state IS NOT NULL AND district IS NOT NULL GROUP BY state, district
            HAVING count(*) >= {MIN_SIZE}
            ORDER BY failure_rate DESC, state, district LIMIT 20)
      SELECT district, {cols} FROM g GROUP BY district"""
    return rsql(inner, [f'"{s}"' for s in states])


@register("district_risk_grid", _a8_sql())
def district_risk_grid(spark, sf_dir):
    """Top-20 (state, district) failure rates pivoted district x state, 0-filled."""
    return stats.district_risk_grid(tracked_customers(spark, sf_dir), min_size=MIN_SIZE)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _a9_sql():
    segs = SEGMENTS
    parts = [f"""SELECT segment AS cohort, '{s.name}' AS step, count(*) AS total,
                 sum(CAST({s.name}_in_window AS INTEGER)) AS completed
               FROM tracked WHERE segment IS NOT NULL GROUP BY segment""" for s in B.CUSTOMER_SPEC.steps]
    cols = ", ".join(f"max(CASE WHEN cohort = '{v}' THEN {pct_sql('completed', 'total')} END) AS {v}"
                     for v in segs)
    inner = f"""{tracked_ctes('customers')}
      SELECT step, {cols} FROM ({' UNION ALL '.join(parts)}) x GROUP BY step"""
    return rsql(inner, list(segs))


@register("cohort_pivot", _a9_sql())
def cohort_pivot(spark, sf_dir):
    """Step x segment matrix of completion %."""
    t = tracked_customers(spark, sf_dir)
    return stats.cohort_pivot(stats.cohort_completion_rates(t, B.CUSTOMER_SPEC, "segment"), SEGMENTS)


#: Districts that get a column of their own; the rest are one ``other`` column.
NAMED_DISTRICTS = ("NATION_0", "NATION_1", "NATION_2")


def _a9_other_sql():
    names = ", ".join(f"'{d}'" for d in NAMED_DISTRICTS)
    parts = [f"""SELECT upper(district) AS cohort, '{s.name}' AS step, count(*) AS total,
                 sum(CAST({s.name}_in_window AS INTEGER)) AS completed
               FROM tracked WHERE district IS NOT NULL GROUP BY 1""" for s in B.CUSTOMER_SPEC.steps]
    cols = ", ".join(f"max(CASE WHEN cohort = '{d}' THEN {pct_sql('completed', 'total')} END) AS \"{d}\"" for d in NAMED_DISTRICTS)
    rest = f"FILTER (WHERE cohort NOT IN ({names}))"
    inner = f"""{tracked_ctes('customers')}
      SELECT step, {cols},
             CASE WHEN count(*) {rest} > 0 THEN {pct_sql(f'sum(completed) {rest}', f'sum(total) {rest}')} END AS other,
             count(*) {rest} AS other_cohorts
      FROM ({' UNION ALL '.join(parts)}) x GROUP BY step"""
    return rsql(inner, [*(f'"{d}"' for d in NAMED_DISTRICTS), "other"])


@register("cohort_pivot_other", _a9_other_sql())
def cohort_pivot_other(spark, sf_dir):
    """A9 over many cohorts: step x three districts, and all others together."""
    t = tracked_customers(spark, sf_dir).withColumn("district", F.upper("district"))
    return stats.cohort_pivot(stats.cohort_completion_rates(t, B.CUSTOMER_SPEC, "district"), NAMED_DISTRICTS, other="other")


# --------------------------------------------------------------------------- A12
def _a12_sql():
    inner = f"""{tracked_ctes('customers')},
      g AS (SELECT CAST(state AS VARCHAR) AS cohort_value, count(*) AS n,
                   sum(CAST(transition_failure AS DOUBLE)) AS failures,
                   avg(CAST(days_to_complete_all AS DOUBLE)) AS m_mean,
                   var_samp(CAST(days_to_complete_all AS DOUBLE)) AS m_var,
                   count(days_to_complete_all) AS m_n
            FROM tracked WHERE state IS NOT NULL GROUP BY state),
      r AS (SELECT n AS ref_n, failures AS ref_failures, m_mean AS ref_mean, m_var AS ref_var, m_n AS ref_m_n
            FROM g WHERE cohort_value = 'EUROPE'),
      j AS (SELECT g.*, r.*, failures / NULLIF(CAST(n AS DOUBLE), 0) AS rate,
                   ref_failures / NULLIF(CAST(ref_n AS DOUBLE), 0) AS ref_rate, 3.841458820694124 AS z2
            FROM g, r),
      w AS (SELECT *, (rate + z2 / (2.0 * n)) / (1.0 + z2 / n) AS center,
                   1.959963984540054 * sqrt(rate * (1.0 - rate) / n + z2 / (4.0 * n * n)) / (1.0 + z2 / n) AS half
            FROM j)
      SELECT cohort_value, n, CAST(failures AS BIGINT) AS failures, rate AS failure_rate,
             center - half AS ci_low, center + half AS ci_high,
             rate / NULLIF(ref_rate, 0) AS risk_ratio, rate - ref_rate AS risk_difference,
             2.0 * asin(sqrt(rate)) - 2.0 * asin(sqrt(ref_rate)) AS cohens_h,
             (m_mean - ref_mean) / NULLIF(sqrt(((m_n - 1) * m_var + (ref_m_n - 1) * ref_var)
                                        / NULLIF(m_n + ref_m_n - 2, 0)), 0) AS cohens_d
      FROM w"""
    return rsql(inner, ["failure_rate", "ci_low", "ci_high", "risk_ratio", "risk_difference",
                        "cohens_h", "cohens_d"])


@register("cohort_effect_sizes", _a12_sql())
def cohort_effect_sizes(spark, sf_dir):
    """Wilson CI, risk ratio/difference, Cohen's h and d per region vs EUROPE."""
    return stats.cohort_effect_sizes(tracked_customers(spark, sf_dir), "state", "EUROPE")


BOOTSTRAP_REPLICATES = 200


def _bootstrap_sql():
    draw = "CAST(('0x' || substr(md5('42:' || CAST(entity_id AS VARCHAR) || ':' || (r // 4)), 8 * (r % 4) + 1, 8)) AS BIGINT) / 4294967296.0"
    times = " + ".join(f"CAST(u >= CAST({t!r} AS DOUBLE) AS INTEGER)" for t in stats.poisson_cdf())
    inner = f"""{tracked_ctes('customers')},
      d AS (SELECT CAST(state AS VARCHAR) AS cohort_value, CAST(transition_failure AS INTEGER) AS y, r, CAST({draw} AS DOUBLE) AS u
            FROM tracked, range(0, {BOOTSTRAP_REPLICATES}) t(r) WHERE state IS NOT NULL AND transition_failure IS NOT NULL),
      s AS (SELECT cohort_value, r, sum(k) AS w, CAST(sum(k * y) AS DOUBLE) / NULLIF(sum(k), 0) AS rate, count(*) AS n, sum(y) AS failures
            FROM (SELECT *, {times} AS k FROM d) GROUP BY cohort_value, r),
      e AS (SELECT *, rate - max(CASE WHEN cohort_value = 'EUROPE' THEN rate END) OVER (PARTITION BY r) AS difference FROM s)
      SELECT cohort_value, max(n) AS n, CAST(max(failures) AS DOUBLE) / max(n) AS failure_rate,
             quantile_cont(rate, 0.025) AS rate_low, quantile_cont(rate, 0.975) AS rate_high,
             quantile_cont(difference, 0.025) AS difference_low, quantile_cont(difference, 0.975) AS difference_high
      FROM e GROUP BY cohort_value"""
    return rsql(inner, ["failure_rate", "rate_low", "rate_high", "difference_low", "difference_high"])


@register("cohort_bootstrap", _bootstrap_sql())
def cohort_bootstrap(spark, sf_dir):
    """Poisson-bootstrap intervals of each region's failure rate and of its difference from EUROPE."""
    return stats.bootstrap_intervals(tracked_customers(spark, sf_dir), "state", "EUROPE", replicates=BOOTSTRAP_REPLICATES)


# --------------------------------------------------------------------------- K5
def _summary_sql():
    steps = B.CUSTOMER_SPEC.steps
    comp = " UNION ALL ".join(
        f"SELECT 'completion' AS section, '{s.name}' AS key, "
        f"{pct_sql(f'sum(CAST({s.name}_in_window AS INTEGER))', 'count(*)')} AS value FROM tracked" for s in steps)
    hr = _a5_sql()
    chi = _a6_sql()
    inner = f"""{tracked_ctes('customers')}
      SELECT 'overview' AS section, 'entities' AS key, CAST(count(*) AS DOUBLE) AS value FROM tracked
      UNION ALL SELECT 'overview', 'failure_rate_pct', 100.0 * avg(CAST(transition_failure AS DOUBLE)) FROM tracked
      UNION ALL {comp}
      UNION ALL SELECT 'tests', test, p_value FROM ({chi}) c
      UNION ALL SELECT 'high_risk', cohort_type || ':' || cohort_value, failure_rate
                FROM (SELECT * FROM ({hr}) h ORDER BY failure_rate DESC, cohort_type, cohort_value LIMIT 10) t"""
    return rsql(inner, ["value"])


@register("policy_summary", _summary_sql())
def policy_summary(spark, sf_dir):
    """K5: the policy report as a (section, key, value) table -- entities, overall
    failure %, completion % per step, chi-square p-values, the ten riskiest cohorts.
    The tracked table is written once (checkpoint) and every section reads it."""
    t = tracked_customers(spark, sf_dir).checkpoint(eager=True)
    n = t.agg(F.lit("overview").alias("section"), F.lit("entities").alias("key"),
              F.count(F.lit(1)).cast("double").alias("value"))
    fail = stats.overall_failure_rate(t).select(F.lit("overview").alias("section"),
                                                F.lit("failure_rate_pct").alias("key"),
                                                (F.col("failure_rate") * 100.0).alias("value"))
    comp = stats.completion_rates(t, B.CUSTOMER_SPEC).select(
        F.lit("completion").alias("section"), F.col("step").alias("key"), F.col("completion_rate_pct").alias("value"))
    tests = stats.chi_square_tests(t).select(F.lit("tests").alias("section"), F.col("test").alias("key"),
                                            F.col("p_value").alias("value"))
    top = (stats.high_risk_cohorts(t, min_size=MIN_SIZE)
           .orderBy(F.desc("failure_rate"), "cohort_type", "cohort_value").limit(10)
           .select(F.lit("high_risk").alias("section"),
                   F.concat_ws(":", "cohort_type", "cohort_value").alias("key"), F.col("failure_rate").alias("value")))
    from ..operators.prep import union_by_name
    return union_by_name([n, fail, comp, tests, top])


def _report_sql():
    inner = f"""SELECT * FROM ({_summary_sql()}) s
      UNION ALL SELECT 'gender', step, divergence_pct_points FROM ({_a3_sql()}) g WHERE abs(relative_divergence) > 5.0
      UNION ALL SELECT 'lag', step, completion_lag_pct_points FROM ({_a4_sql()}) l"""
    return rsql(inner, ["value"])


@register("policy_report", _report_sql())
def policy_report(spark, sf_dir):
    """K5 with the reference's remaining sections: gender gaps of over five points, lag between areas."""
    gender, lag = stats.gap_lines(tracked_customers(spark, sf_dir).checkpoint(eager=True), B.CUSTOMER_SPEC)
    from ..operators.prep import union_by_name
    return union_by_name([policy_summary(spark, sf_dir),
                          gender.select(F.lit("gender").alias("section"), F.col("step").alias("key"), F.col("divergence_pct_points").alias("value")),
                          lag.select(F.lit("lag").alias("section"), F.col("step").alias("key"), F.col("completion_lag_pct_points").alias("value"))])


# --------------------------------------------------------------------------- C9, C10 on B2
def _days_only_sql():
    cols = []
    for st in B.USER_SPEC.steps:
        d = f"{st.name}_days_after_anchor"
        cols += [f"coalesce({d} >= {st.lo} AND {d} <= {st.hi}, false) AS {st.name}_days_window",
                 f"coalesce({d} <= {st.hi} AND {d} < 999, false) AS {st.name}_hi_only"]
    return f"{tracked_ctes('users')} SELECT entity_id, {', '.join(cols)} FROM tracked"


@register("window_from_days_only", _days_only_sql())
def window_from_days_only(spark, sf_dir):
    """C9 (day-based window test, without the reference's OR quirk) and C10 (upper
    bound only) evaluated from the day counts of the users binding."""
    ent, log, spec = B.users(spark, sf_dir)
    t = cascade.track(ent, log, spec)
    cols = []
    for st in spec.steps:
        d = F.col(f"{st.name}_days_after_anchor")
        cols += [F.coalesce((d >= st.lo) & (d <= st.hi), F.lit(False)).alias(f"{st.name}_days_window"),
                 cascade.window_from_days(f"{st.name}_days_after_anchor", hi=st.hi).alias(f"{st.name}_hi_only")]
    return t.select("entity_id", *cols)
