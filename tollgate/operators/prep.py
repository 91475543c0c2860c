"""Cleaning, lookups, count joins and count-to-row expansion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import parse_dmy, python_title, threshold_category


def clean_counts(df: DataFrame, date_col: str = "date", name_cols=("state", "district"),
                 pincode_col: str | None = "pincode", urban_threshold: int = 500000) -> DataFrame:
    """P1 + P3 + P4: parse ``d-M-yyyy`` dates (NULL when invalid), title-case the name
    columns like Python, and derive ``urban_rural`` from the pincode threshold."""
    out = df.withColumn(date_col, parse_dmy(F.col(date_col)))
    for c in name_cols:
        if c in df.columns:
            out = out.withColumn(c, python_title(F.col(c)))
    if pincode_col and pincode_col in df.columns:
        out = out.withColumn("urban_rural", threshold_category(F.col(pincode_col), urban_threshold,
                                                               "Urban", "Rural"))
    return out


def null_safe_condition(left: DataFrame, right: DataFrame, keys) -> Column:
    """Equality on every key with NULL = NULL (pandas merge semantics).  Catalyst still
    plans it as an equi-join (on coalesce/isnull pairs), not a nested loop."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def left_join_counts(base: DataFrame, other: DataFrame, keys, measure: str, alias: str,
                     dedupe: bool = True, null_safe: bool = True) -> DataFrame:
    """Attach a count column from a second count table.

    ``dedupe=True`` (default) pre-aggregates ``other`` to one row per key with ``sum``,
    so duplicate keys cannot multiply base rows (fixes Q18) and the join input shrinks
    before the shuffle; ``dedupe=False`` keeps the reference's fan-out.
    """
    keys = list(keys)
    if dedupe:
        other = other.groupBy(*keys).agg(F.sum(measure).alias(alias))
    else:
        other = other.select(*keys, F.col(measure).alias(alias))
    o = other.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col(alias))
    if null_safe:
        cond = reduce(lambda a, b: a & b, [base[k].eqNullSafe(o[f"__r_{k}"]) for k in keys])
    else:
        cond = reduce(lambda a, b: a & b, [base[k] == o[f"__r_{k}"] for k in keys])
    return base.join(o, cond, "left").drop(*[f"__r_{k}" for k in keys])


def expand_counts(df: DataFrame, count_col: str, key_cols, chunk: int = 1_000_000,
                  spread: int | None = None) -> DataFrame:
    """J9 + P8: one output row per counted unit (count n -> n rows, ``idx`` 0..n-1);
    rows with a NULL or non-positive count are skipped.

    A single count can be huge (one key holding a third of the data), so each row is
    first cut into chunks of at most ``chunk`` units; the small chunk descriptors are
    spread over the cluster (``repartition``) and only then exploded, so no task
    generates more than about ``chunk`` x (chunks per task) rows.
    """
    n = F.col(count_col).cast("long")
    base = df.where(n > 0)
    chunks = base.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.floor((n - 1) / F.lit(chunk)).cast("long"))))
    if not spread:
        spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(spread)
    lo = F.col("__chunk") * F.lit(chunk)
    hi = F.least(lo + F.lit(chunk), n) - F.lit(1)
    rows = chunks.withColumn("idx", F.explode(F.sequence(lo, hi))).drop("__chunk")
    # length-prefixed keys ("len:value", "-" for NULL) make the id injective even when
    # values contain the separator
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"),
                                 F.col(k).cast("string")), F.lit("-")) for k in key_cols]
    eid = F.concat_ws("|", *parts, F.col("idx").cast("string"))
    return rows.withColumn("entity_id", eid)


def per_unit_rate(num_col: str, den_col: str, default: float = 0.0) -> Column:
    """Per-person share of a count (count / n), ``default`` when absent."""
    return F.coalesce(F.try_divide(F.col(num_col).cast("double"), F.col(den_col).cast("double")),
                      F.lit(default))


def union_by_name(dfs) -> DataFrame:
    """Bag union by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def with_default(df: DataFrame, col: str, default, dtype: str) -> DataFrame:
    """Add ``col`` with a literal default when the source lacks it."""
    if col in df.columns:
        return df
    return df.withColumn(col, F.lit(default).cast(dtype))


def validate_required(df: DataFrame, required) -> DataFrame:
    """Add ``error`` (NULL when valid) naming the first missing required field."""
    err = F.lit(None).cast("string")
    for c in reversed(list(required)):
        err = F.when(F.col(c).isNull(), F.lit(f"Missing required field: {c}")).otherwise(err)
    return df.withColumn("error", err)
