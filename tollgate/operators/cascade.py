"""Milestone-cascade tracking (the core operator).

Plan shape (``track``)::

    step_log --filter(step IN spec)--+ (hot entities salted, see per_entity_steps)
                                     +-- inner join on (entity, salt) -> per-row flags
    entities.select(entity, anchor) -+
        -> groupBy(entity, salt) then groupBy(entity): conditional min per step
           (partial + final aggregates)
        -> entities LEFT JOIN per-entity result -> projections

No window function over an entity, no per-step joins (one conditional aggregate
handles every step), no rows collected per entity, and an entity holding a third of
the log is spread over many tasks by explicit salting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import add_days, floor_days
from ..spec import CascadeSpec


def in_window_expr(spec: CascadeSpec, step, ts: Column, anchor: Column) -> Column:
    """NULL-free in-window test of one event (C3 / C9 without the OR quirk)."""
    if spec.mode == "timestamp":
        cond = (ts >= add_days(anchor, step.lo)) & (ts <= add_days(anchor, step.hi))
    else:
        d = floor_days(ts, anchor)
        cond = (d >= F.lit(step.lo)) & (d <= F.lit(step.hi))
    return F.coalesce(cond, F.lit(False))


def step_events(step_log: DataFrame, spec: CascadeSpec) -> DataFrame:
    """Project the step log to (entity, step, ts) for the steps of the spec.

    The ``IN`` filter and the three-column projection reach the parquet scan.
    """
    values = [s.value for s in spec.steps]
    return (step_log
            .select(F.col(spec.entity_col), F.col(spec.step_col),
                    F.col(spec.ts_col).cast("timestamp").alias(spec.ts_col))
            .where(F.col(spec.step_col).isin(values) & F.col(spec.ts_col).isNotNull()))


def hot_entities(events: DataFrame, entity: str, skew_rows: int) -> DataFrame:
    """Entities with more than ``skew_rows`` events and the number of salts for each.

    Counting is a partial + final aggregate (a hot key collapses map-side).  The list is
    joined by key and never collected; its size decides how.
    """
    return (events.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > F.lit(skew_rows))
            .select(entity, F.ceil(F.col("__n") / F.lit(skew_rows)).cast("int").alias("__salts")))


def per_entity_steps(entities: DataFrame, step_log: DataFrame, spec: CascadeSpec,
                     skew_rows: int | None = None) -> DataFrame:
    """One row per entity that has events: chosen event time and window flag per step.

    Skew: a hot entity (say a third of the log) makes one join partition large.  By default
    adaptive execution splits it (``forceOptimizeSkewedJoin``: the split join is followed by a
    partial aggregate in each piece, so only one row per piece and entity is shuffled
    again), which costs nothing when there is none.  ``skew_rows`` asks for explicit
    salting instead, for clusters without adaptive execution: an entity with more
    events is split over ``ceil(n / skew_rows)`` salts -- its events by a hash of the event,
    its single anchor row replicated once per salt -- and the aggregate runs in two
    levels (entity+salt, then entity).  Both give the same rows.
    """
    e, a, st, ts = spec.entity_col, spec.anchor_col, spec.step_col, spec.ts_col
    anchors = (entities.select(F.col(e), F.col(a).cast("timestamp").alias(a))
               .where(F.col(a).isNotNull()))
    events = step_events(step_log, spec)
    keys = [e]
    if skew_rows:
        hot = hot_entities(events, e, skew_rows)
        salt = F.when(F.col("__salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(F.col(st), F.col(ts)), F.col("__salts")).cast("int"))
        events = events.join(hot, e, "left").withColumn("__salt", salt).drop("__salts")
        anchors = (anchors.join(hot, e, "left")
                   .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)))
                   .drop("__salts"))
        keys = [e, "__salt"]
    ev = events.join(anchors, on=keys, how="inner")
    tsc, anc = F.col(ts), F.col(a)
    aggs = []
    for s in spec.steps:
        is_s = F.col(st) == F.lit(s.value)
        inw = in_window_expr(spec, s, tsc, anc)
        if spec.policy == "earliest":
            aggs.append(F.min(F.when(is_s, tsc)).alias(f"__{s.name}_ts"))
        else:
            aggs.append(F.min(F.when(is_s & (tsc >= anc), tsc)).alias(f"__{s.name}_after"))
            if spec.policy == "any":
                aggs.append(F.min(F.when(is_s & inw, tsc)).alias(f"__{s.name}_win"))
    g = ev.groupBy(*keys).agg(*aggs)
    if skew_rows:  # second level: min over the salts of one entity
        g = g.groupBy(e).agg(*[F.min(c).alias(c) for c in g.columns if c not in keys])
    cols = [F.col(e)]
    for s in spec.steps:
        if spec.policy == "earliest":
            cols.append(F.col(f"__{s.name}_ts").alias(f"__{s.name}_ts"))
        elif spec.policy == "first":
            cols.append(F.col(f"__{s.name}_after").alias(f"__{s.name}_ts"))
        else:
            cols.append(F.coalesce(F.col(f"__{s.name}_win"), F.col(f"__{s.name}_after"))
                        .alias(f"__{s.name}_ts"))
    return g.select(*cols)


def track(entities: DataFrame, step_log: DataFrame, spec: CascadeSpec,
          skew_rows: int | None = None) -> DataFrame:
    """The tracked table, one row per entity (all entity columns kept).

    Per step ``s``: ``s_updated`` (bool), ``s_update_ts`` (timestamp),
    ``s_days_after_anchor`` (bigint, floor days, may be negative for ``earliest``) and
    ``s_in_window`` (bool, never NULL).  Then ``transition_failure`` (any window missed)
    and ``days_to_complete_all`` (largest day count, NULL only when no step happened).
    """
    e, a = spec.entity_col, spec.anchor_col
    steps = per_entity_steps(entities, step_log, spec, skew_rows)
    ent = entities.withColumn(a, F.col(a).cast("timestamp"))
    j = ent.join(steps, on=e, how="left")
    anc = F.col(a)
    out = [F.col(c) for c in ent.columns]
    for s in spec.steps:
        t = F.col(f"__{s.name}_ts")
        days = floor_days(t, anc)
        out += [
            t.isNotNull().alias(f"{s.name}_updated"),
            t.alias(f"{s.name}_update_ts"),
            days.alias(f"{s.name}_days_after_anchor"),
            in_window_expr(spec, s, t, anc).alias(f"{s.name}_in_window"),
        ]
    tracked = j.select(*out)
    fail = F.lit(False)
    for s in spec.steps:
        fail = fail | ~F.col(f"{s.name}_in_window")
    day_cols = [F.col(f"{s.name}_days_after_anchor") for s in spec.steps]
    most = day_cols[0] if len(day_cols) == 1 else F.greatest(*day_cols)
    return (tracked
            .withColumn("transition_failure", fail)
            .withColumn("days_to_complete_all", most))


def anchor_plus_days(dob_col: str, days: int = 6570, calendar: bool = False) -> Column:
    """Anchor from a birth date: exact ``days`` x 24 h (default 18 x 365), or
    calendar months (``add_months(dob, 216)``) when ``calendar=True``."""
    if calendar:
        return F.add_months(F.col(dob_col).cast("date"), days // 365 * 12).cast("timestamp")
    return add_days(F.col(dob_col), days)


def window_from_days(days_col: str, hi: int, lo: int | None = None) -> Column:
    """Window flag from a day count alone (999 = never).  The reference ignores the
    lower bound; pass ``lo`` for the strict variant."""
    d = F.col(days_col)
    cond = (d <= F.lit(hi)) & (d < F.lit(999))
    if lo is not None:
        cond = cond & (d >= F.lit(lo))
    return F.coalesce(cond, F.lit(False))


def current_age(dob_col: str, as_of: str) -> Column:
    """Floor days from birth to a fixed ``as_of`` date divided by 365.25."""
    return floor_days(F.lit(as_of).cast("timestamp"), F.col(dob_col)) / F.lit(365.25)
