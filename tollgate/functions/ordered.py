"""Exact running sums over a global order without a single-task window.

``Window.orderBy(x)`` with no partition moves every row to one task.  Instead:

1. assign each row a *range bucket* that is monotone in the order: ``repartitionByRange``
   samples the boundaries and a checkpoint freezes the partition ids, or the caller
   supplies a monotone expression of its own;
2. total the measures per bucket and turn them into bucket offsets with a window over
   that table (one row per bucket);
3. attach the offsets and run the window inside each bucket only
   (``partitionBy(bucket)``).

Every row gets the exact inclusive running sum.  Boundaries only affect balance, never
the result.  The number of buckets follows the session's shuffle partitions without a
ceiling, so rows per bucket stay level when a deployment raises them with its data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one rank part should hold where the caller knows the row count.
PART_ROWS = 100_000


def default_buckets(df: DataFrame) -> int:
    """4 x shuffle partitions."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_buckets(df: DataFrame, order_cols, buckets: int | None = None, out: str = "__bucket") -> DataFrame:
    """Add ``out``: the range partition of ``order_cols``, frozen by a checkpoint (so a
    recomputed task cannot land rows in a different bucket).  Boundaries come from Spark's
    range sampling: a bounded sample for each partition, whatever the row count."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(buckets or default_buckets(df), *order_cols)
            .withColumn(out, F.spark_partition_id()).checkpoint(eager=True))


def running_sums(df: DataFrame, order_cols, sum_cols, bucket: Column | None = None,
                 buckets: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``{prefix}{c}`` = sum of ``c`` over all rows ordered at or before this row
    (ascending ``order_cols``; give a negated column for descending order).

    ``order_cols`` must identify rows uniquely (group by the key first when it does
    not).  ``bucket`` is an optional int expression monotone in the order; without it
    range buckets of the order columns are used.
    """
    order_cols, sum_cols = list(order_cols), list(sum_cols)
    if bucket is not None:
        b = df.withColumn("__bucket", bucket.cast("long"))
    else:
        b = range_buckets(df, order_cols, buckets)
    totals = b.groupBy("__bucket").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    # one row per bucket: a single small task, and a small table to attach
    w_all = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__bucket", *[F.coalesce(F.sum(f"__t_{c}").over(w_all), F.lit(0))
                                          .alias(f"__o_{c}") for c in sum_cols])
    j = b.join(offsets, "__bucket", "left")  # left to the planner: AQE measures the offsets
    w = (Window.partitionBy("__bucket").orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = j
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__o_{c}") + F.sum(c).over(w))
    return out.drop("__bucket", *[f"__o_{c}" for c in sum_cols])


def part_ranks(df: DataFrame, group: Column, digest: str, out: str, size: str, digits: int) -> DataFrame:
    """Add ``out``, the 1-based rank within ``group`` (any type, NULL is a group) in the order of
    the hex column ``digest`` (unique within a group), and ``size``, the group's row count.

    Rows are numbered within (group, first ``digits`` hex digits) and shifted by the counts
    of the parts before, so no task sorts a whole group; take digits from ``hex_digits``."""
    df = df.withColumn("__g", F.struct(group.isNull().alias("no"), F.coalesce(group.cast("string"), F.lit("")).alias("v")))
    df = df.withColumn("__p", F.substring(digest, 1, digits))
    parts = df.groupBy("__g", "__p").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__g")
    parts = parts.select("__g", "__p", F.coalesce(F.sum("__n").over(w.orderBy("__p").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(w).alias(size))
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy("__g", "__p").orderBy(digest)))
    return (ranked.join(parts, ["__g", "__p"]).withColumn(out, F.col(out) + F.col("__before"))
            .drop("__g", "__p", "__before"))


def hex_digits(rows: int) -> int:
    """Leading hex digits that cut ``rows`` rows into parts of about ``PART_ROWS``."""
    return max(1, math.ceil(math.log(max(1.0, rows / PART_ROWS), 16)) + 1)


def exact_quantiles(df: DataFrame, cols, q: float = 0.5, buckets: int | None = None) -> dict:
    """Exact linear-interpolated quantile (pandas/DuckDB ``median`` for q=0.5) of each numeric
    column, in a constant number of jobs whatever the number of columns: the columns are
    stacked to (column, value, count) by a partial aggregate (a hot value costs one row),
    ranked together with ``running_sums``, and only the one or two rows at each column's
    target ranks reach the driver.  None for a column without values."""
    cols = list(cols)
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v"))
                                           for i, c in enumerate(cols)])))
    g = stacked.where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    totals = {r["c"]: r["n"] for r in g.groupBy("c").agg(F.sum("n").alias("n")).collect()}  # one row per column
    ranked = running_sums(g, ["c", "v"], ["n"], buckets=buckets)
    before, wanted, hit = 0, {}, F.lit(False)
    for i in sorted(totals):
        pos = (totals[i] - 1) * q
        wanted[i] = (before, pos, math.floor(pos), math.ceil(pos))
        for k in {before + wanted[i][2], before + wanted[i][3]}:  # the row with cum_n - n <= k < cum_n
            hit = hit | ((F.col("cum_n") - F.col("n") <= k) & (F.col("cum_n") > k))
        before += totals[i]
    rows = ranked.where(hit).select("c", "v", "n", "cum_n").collect() if wanted else []

    def at(k):
        return next(r["v"] for r in rows if r["cum_n"] - r["n"] <= k < r["cum_n"])

    out: dict = dict.fromkeys(cols)
    for i, (start, pos, k1, k2) in wanted.items():
        v1, v2 = at(start + k1), at(start + k2)
        out[cols[i]] = v1 + (v2 - v1) * (pos - k1)
    return out


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, buckets: int | None = None):
    """``exact_quantiles`` of one column."""
    return exact_quantiles(df, [col], q, buckets)[col]


def range_ranks(df: DataFrame, order_cols, out: str = "rank", buckets: int | None = None) -> DataFrame:
    """1-based row numbers of ``df`` in ascending ``order_cols`` (unique), for keys of
    any orderable type (strings included) and any cardinality."""
    r = running_sums(df.withColumn("__one", F.lit(1)), order_cols, ["__one"], buckets=buckets)
    return r.withColumnRenamed("cum___one", out).drop("__one")
