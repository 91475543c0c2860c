"""Queries for cleaning, joins of count tables and expansion (P, J, S4) on B4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import parse_dmy, python_title, threshold_category
from ..operators import prep
from ..sources.tables import table
from .catalog import register
from .q_cascade import rsql
from .sqlgen import id_sql


# --------------------------------------------------------------------------- P1
_DATES_SQL = """
WITH t AS (
  SELECT o_orderkey, 'dd-MM' AS variant, strftime(o_orderdate, '%d-%m-%Y') AS text FROM orders
  UNION ALL SELECT o_orderkey, 'd-M', strftime(o_orderdate, '%-d-%-m-%Y') FROM orders
  UNION ALL SELECT o_orderkey, 'iso', strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL SELECT o_orderkey, 'feb31', '31-02-' || strftime(o_orderdate, '%Y') FROM orders
  UNION ALL SELECT o_orderkey, 'padded', '  ' || strftime(o_orderdate, '%d-%m-%Y') || ' ' FROM orders)
SELECT o_orderkey, variant, text, try_strptime(trim(text), '%d-%m-%Y') AS parsed FROM t"""


@register("clean_dates", _DATES_SQL)
def clean_dates(spark, sf_dir):
    """Tolerant d-M-yyyy parse of order dates rendered five ways (two valid widths,
    ISO order, impossible 31 February, padded)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("d"))
    variants = [("dd-MM", F.date_format("d", "dd-MM-yyyy")), ("d-M", F.date_format("d", "d-M-yyyy")),
                ("iso", F.date_format("d", "yyyy-MM-dd")),
                ("feb31", F.concat(F.lit("31-02-"), F.date_format("d", "yyyy"))),
                ("padded", F.concat(F.lit("  "), F.date_format("d", "dd-MM-yyyy"), F.lit(" ")))]
    t = o.select("o_orderkey", F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), e.alias("text"))
                                                    for v, e in variants])).alias("v")).select(
        "o_orderkey", "v.variant", "v.text")
    return t.withColumn("parsed", parse_dmy(F.col("text")))


# --------------------------------------------------------------------------- P3
_TITLE_SQL = r"""
WITH t AS (SELECT p_partkey, '  ' || p_name || '-' || lower(p_type) || ' o''' || p_brand || ' ' AS raw FROM part)
SELECT p_partkey, raw,
       array_to_string(list_transform(regexp_extract_all(lower(trim(raw)), '(\p{L}+|\P{L}+)'),
                                      lambda w: upper(w[1]) || w[2:]), '') AS titled
FROM t"""


@register("title_case", _TITLE_SQL)
def title_case(spark, sf_dir):
    """Python-style title case of padded, hyphenated, apostrophe names."""
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit("-"), F.lower("p_type"), F.lit(" o'"),
                   F.col("p_brand"), F.lit(" "))
    return p.select("p_partkey", raw.alias("raw")).withColumn("titled", python_title(F.col("raw")))


# --------------------------------------------------------------------------- P4
_THRESH_SQL = """
WITH f AS (SELECT o_custkey, max(o_totalprice) AS max_open FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
SELECT c.c_custkey, c.c_acctbal, f.max_open,
       CASE WHEN c.c_acctbal > 5000 THEN 'Urban' ELSE 'Rural' END AS area,
       CASE WHEN f.max_open > 300000 THEN 'High' ELSE 'Low' END AS open_band
FROM customer c LEFT JOIN f ON c.c_custkey = f.o_custkey"""


@register("threshold_category", rsql(_THRESH_SQL, ["c_acctbal", "max_open"]))
def threshold_category_q(spark, sf_dir):
    """Threshold categories; NULL (customer without open orders) falls to the
    `otherwise` label."""
    c = table(spark, sf_dir, "customer")
    f = (table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
         .groupBy("o_custkey").agg(F.max("o_totalprice").alias("max_open")))
    j = c.join(f, c.c_custkey == f.o_custkey, "left")
    return j.select("c_custkey", "c_acctbal", "max_open",
                    threshold_category(F.col("c_acctbal"), 5000, "Urban", "Rural").alias("area"),
                    threshold_category(F.col("max_open"), 300000, "High", "Low").alias("open_band"))


# --------------------------------------------------------------------------- B4 count tables
def _district(null_every: int | None):
    d = F.col("n_name")
    if null_every:
        d = F.when(F.col("n_nationkey") % null_every == 0, F.lit(None).cast("string")).otherwise(d)
    return d


def order_counts(spark, sf_dir, null_every=None):
    """B4 count table 1: orders per (date text, district, segment)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return (j.groupBy(F.date_format("o_orderdate", "dd-MM-yyyy").alias("date"),
                      _district(null_every).alias("district"), F.col("c_mktsegment").alias("segment"))
            .agg(F.count(F.lit(1)).alias("n_orders")))


def line_counts(spark, sf_dir, null_every=None):
    """B4 count table 2: line items per (date, district, segment, return flag) -- finer
    than the join key, so it holds several rows per key."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey))
    return (j.groupBy(F.date_format("o_orderdate", "dd-MM-yyyy").alias("date"),
                      _district(null_every).alias("district"), F.col("c_mktsegment").alias("segment"),
                      "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_lines")))


def _counts_sql(null_every=None):
    dist = (f"CASE WHEN n.n_nationkey % {null_every} = 0 THEN NULL ELSE n.n_name END" if null_every
            else "n.n_name")
    return f"""
  oc AS (SELECT strftime(o.o_orderdate, '%d-%m-%Y') AS date, {dist} AS district, c.c_mktsegment AS segment,
                count(*) AS n_orders
         FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
         GROUP BY 1, 2, 3),
  lc AS (SELECT strftime(o.o_orderdate, '%d-%m-%Y') AS date, {dist} AS district, c.c_mktsegment AS segment,
                l.l_returnflag, count(*) AS n_lines
         FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
         JOIN nation n ON c.c_nationkey = n.n_nationkey
         GROUP BY 1, 2, 3, 4)"""


KEYS = ("date", "district", "segment")


def _join_counts_sql(null_every=None, dedupe=True):
    on = " AND ".join(f"oc.{k} IS NOT DISTINCT FROM l.{k}" for k in KEYS)
    if dedupe:
        right = "(SELECT date, district, segment, CAST(sum(n_lines) AS BIGINT) AS n_lines FROM lc GROUP BY 1, 2, 3)"
    else:
        right = "(SELECT date, district, segment, n_lines FROM lc)"
    inner = f"""WITH {_counts_sql(null_every)}
      SELECT oc.date, oc.district, oc.segment, oc.n_orders, l.n_lines,
             coalesce(CAST(l.n_lines AS DOUBLE) / NULLIF(CAST(oc.n_orders AS DOUBLE), 0), 0.0) AS lines_per_order
      FROM oc LEFT JOIN {right} l ON {on} WHERE oc.n_orders > 0"""
    return rsql(inner, ["lines_per_order"])


def _join_counts(spark, sf_dir, null_every=None, dedupe=True):
    base = order_counts(spark, sf_dir, null_every).where(F.col("n_orders") > 0)
    lines = line_counts(spark, sf_dir, null_every)
    j = prep.left_join_counts(base, lines, KEYS, "n_lines", "n_lines", dedupe=dedupe)
    return j.select(*KEYS, "n_orders", F.col("n_lines").cast("long").alias("n_lines"),
                    prep.per_unit_rate("n_lines", "n_orders").alias("lines_per_order"))


@register("aggregate_left_join", _join_counts_sql())
def aggregate_left_join(spark, sf_dir):
    """J1/J2 + P7/P8: count table left-joined to a pre-aggregated second count table."""
    return _join_counts(spark, sf_dir)


@register("aggregate_left_join_fanout", _join_counts_sql(dedupe=False))
def aggregate_left_join_fanout(spark, sf_dir):
    """J1 with the reference's fan-out (Q18): duplicate right keys multiply base rows."""
    return _join_counts(spark, sf_dir, dedupe=False)


@register("null_safe_left_join", _join_counts_sql(null_every=5))
def null_safe_left_join(spark, sf_dir):
    """J1 with NULL join keys on both sides matched null-safely (pandas semantics)."""
    return _join_counts(spark, sf_dir, null_every=5)


def _expand_sql():
    inner = f"""WITH {_counts_sql()},
      lt AS (SELECT date, district, segment, sum(n_lines) AS n_lines FROM lc GROUP BY 1, 2, 3),
      b AS (SELECT oc.*, coalesce(CAST(lt.n_lines AS DOUBLE) / NULLIF(CAST(oc.n_orders AS DOUBLE), 0), 0.0)
                   AS lines_per_person
            FROM oc LEFT JOIN lt ON oc.date = lt.date AND oc.district = lt.district AND oc.segment = lt.segment
            WHERE oc.n_orders > 0)
      SELECT {id_sql(('date', 'district', 'segment'), 'g.idx')} AS entity_id,
             date, district, segment, CAST(g.idx AS BIGINT) AS idx, lines_per_person
      FROM b, LATERAL (SELECT unnest(range(0, b.n_orders)) AS idx) g"""
    return rsql(inner, ["lines_per_person"])


@register("expand_counts", _expand_sql())
def expand_counts(spark, sf_dir):
    """One row per counted order (count n -> n rows), per-person share of lines."""
    base = _join_counts(spark, sf_dir)
    rows = prep.expand_counts(base, "n_orders", KEYS)
    return rows.select("entity_id", *KEYS, "idx", F.col("lines_per_order").alias("lines_per_person"))


# --------------------------------------------------------------------------- S4
_UNION_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey, o_custkey, NULL::DOUBLE AS o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1"""


@register("union_by_name", _UNION_SQL)
def union_by_name(spark, sf_dir):
    """Union of two files with different columns (absent ones become NULL)."""
    o = table(spark, sf_dir, "orders")
    a = o.where(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.where(F.col("o_orderkey") % 2 == 1).select("o_orderstatus", "o_orderkey", "o_custkey")
    return prep.union_by_name([a, b])


# --------------------------------------------------------------------------- P17
_VALID_SQL = """
WITH r AS (SELECT c_custkey AS entity_id,
                  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END END AS gender,
                  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS state,
                  c_acctbal FROM customer)
SELECT entity_id, gender, state,
       CASE WHEN gender IS NULL THEN 'Missing required field: gender'
            WHEN state IS NULL THEN 'Missing required field: state' END AS error
FROM r"""


@register("score_validation", _VALID_SQL)
def score_validation(spark, sf_dir):
    """Required-field validation of scoring requests; invalid rows keep an
    ``error`` message instead of being dropped."""
    c = table(spark, sf_dir, "customer")
    r = c.select(F.col("c_custkey").alias("entity_id"),
                 F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
                 .otherwise(F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F")).alias("gender"),
                 F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("c_mktsegment")).alias("state"))
    return prep.validate_required(r, ["gender", "state"])
