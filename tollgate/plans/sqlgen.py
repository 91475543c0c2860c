"""DuckDB SQL text for the oracles: the tracked cascade table of each binding written
directly in SQL (CTEs), so each oracle is an independent formulation of the query."""

from __future__ import annotations

from ..sources.bindings import ACCTBAL_URBAN_THRESHOLD, CUSTOMER_SPEC, ORDER_SPEC, USER_SPEC
from ..spec import CascadeSpec

DAY_US = "86400000000.0"


def floor_days_sql(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / {DAY_US}) AS BIGINT)"


def in_window_sql(spec: CascadeSpec, s, ts: str, anchor: str) -> str:
    if spec.mode == "timestamp":
        cond = (f"({ts} >= {anchor} + INTERVAL {s.lo} DAY AND "
                f"{ts} <= {anchor} + INTERVAL {s.hi} DAY)")
    else:
        d = floor_days_sql(ts, anchor)
        cond = f"({d} >= {s.lo} AND {d} <= {s.hi})"
    return f"coalesce({cond}, false)"


CUSTOMER_ENTITIES = f"""
  anchors AS (SELECT o_custkey AS entity_id, min(o_orderdate) AS anchor_ts FROM orders GROUP BY o_custkey),
  ent AS (
    SELECT c.c_custkey AS entity_id, a.anchor_ts, r.r_name AS state, n.n_name AS district,
           c.c_mktsegment AS segment,
           CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
           CASE WHEN c.c_acctbal > {ACCTBAL_URBAN_THRESHOLD} THEN 'Urban' ELSE 'Rural' END AS urban_rural,
           c.c_acctbal AS acctbal
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN anchors a ON c.c_custkey = a.entity_id),
  log AS (SELECT o_custkey AS entity_id, o_orderpriority AS step_type, o_orderdate AS step_ts FROM orders)"""

USER_ENTITIES = """
  ent AS (SELECT user_id AS entity_id, min(ts) AS anchor_ts,
                 'g' || CAST(user_id % 3 AS VARCHAR) AS user_group
          FROM events GROUP BY user_id),
  log AS (SELECT user_id AS entity_id, event_type AS step_type, ts AS step_ts FROM events)"""

ORDER_ENTITIES = """
  ent AS (SELECT o_orderkey AS entity_id, o_orderdate AS anchor_ts, o_orderstatus, o_orderpriority
          FROM orders),
  log AS (SELECT l_orderkey AS entity_id, l_returnflag AS step_type, l_shipdate AS step_ts FROM lineitem)"""

def _u(seed: str, key: str = "entity_id") -> str:
    return f"(CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8)) AS BIGINT) / 4294967296.0)"


def id_sql(keys, idx: str) -> str:
    """The expanded-row id of ``prep.expand_counts``: length-prefixed keys, then idx."""
    parts = [f"coalesce(CAST(length({k}) AS VARCHAR) || ':' || {k}, '-')" for k in keys]
    return " || '|' || ".join(parts + [f"CAST({idx} AS VARCHAR)"])


BINDINGS = {
    "customers": (CUSTOMER_ENTITIES, CUSTOMER_SPEC),
    "users": (USER_ENTITIES, USER_SPEC),
    "orders": (ORDER_ENTITIES, ORDER_SPEC),
}


def tracked_ctes(binding: str, spec: CascadeSpec | None = None) -> str:
    """``WITH ... , tracked AS (...)`` for a binding (no trailing SELECT)."""
    ent_sql, default_spec = BINDINGS[binding]
    spec = spec or default_spec
    values = ", ".join(f"'{s.value}'" for s in spec.steps)
    per_cols = []
    for s in spec.steps:
        is_s = f"step_type = '{s.value}'"
        if spec.policy == "earliest":
            per_cols.append(f"min(CASE WHEN {is_s} THEN step_ts END) AS {s.name}_t")
        elif spec.policy == "first":
            per_cols.append(f"min(CASE WHEN {is_s} AND step_ts >= anchor_ts THEN step_ts END) AS {s.name}_t")
        else:
            inw = in_window_sql(spec, s, "step_ts", "anchor_ts")
            per_cols.append(
                f"coalesce(min(CASE WHEN {is_s} AND {inw} THEN step_ts END), "
                f"min(CASE WHEN {is_s} AND step_ts >= anchor_ts THEN step_ts END)) AS {s.name}_t")
    step_cols = []
    for s in spec.steps:
        t = f"p.{s.name}_t"
        step_cols += [
            f"{t} IS NOT NULL AS {s.name}_updated",
            f"{t} AS {s.name}_update_ts",
            f"{floor_days_sql(t, 'e.anchor_ts')} AS {s.name}_days_after_anchor",
            f"{in_window_sql(spec, s, t, 'e.anchor_ts')} AS {s.name}_in_window",
        ]
    fail = " OR ".join(f"NOT {s.name}_in_window" for s in spec.steps)
    most = (f"greatest({', '.join(f'{s.name}_days_after_anchor' for s in spec.steps)})"
            if len(spec.steps) > 1 else f"{spec.steps[0].name}_days_after_anchor")
    return f"""WITH {ent_sql},
  ev AS (
    SELECT l.entity_id, l.step_type, l.step_ts, e.anchor_ts
    FROM log l JOIN ent e ON l.entity_id = e.entity_id
    WHERE l.step_type IN ({values}) AND l.step_ts IS NOT NULL AND e.anchor_ts IS NOT NULL),
  per AS (SELECT entity_id, {', '.join(per_cols)} FROM ev GROUP BY entity_id),
  tracked0 AS (
    SELECT e.*, {', '.join(step_cols)}
    FROM ent e LEFT JOIN per p ON e.entity_id = p.entity_id),
  tracked AS (SELECT *, ({fail}) AS transition_failure, {most} AS days_to_complete_all FROM tracked0)"""


def tracked_select_list(spec: CascadeSpec, extra=()) -> str:
    cols = ["entity_id", "anchor_ts", *extra]
    for s in spec.steps:
        cols += [f"{s.name}_updated", f"{s.name}_update_ts", f"{s.name}_days_after_anchor",
                 f"{s.name}_in_window"]
    cols += ["transition_failure", "days_to_complete_all"]
    return ", ".join(cols)


def pct_sql(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100.0, 0.0)"
