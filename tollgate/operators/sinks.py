"""Sinks (K1-K6): every output goes through a Spark writer.

Large tables (the tracked cascade, scored rows) are written partitioned and in
parallel; the small statistic tables are coalesced to one file because they are a
handful of rows by construction.  The policy summary (K5) is assembled as a
(section, key, value) table and written as text lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "overwrite") -> None:
    """K1/K6: full-size write, one file per task, optional ``partitionBy``."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, sort_by=(), spread: int = 4) -> DataFrame:
    """K1 for tables that are joined by ``key`` again and again: an external table of hash buckets,
    sorted within files, returned as its scan.  Two such tables of as many buckets join, and then
    aggregate by the key, without a shuffle.

    A bucket is written by ``spread`` tasks (a hash of the other columns deals its rows), so a hot key
    does not fall on one.  A join of buckets does read a bucket in one task: with a hot key, read the
    files by path instead (``spark.read.parquet``), and adaptive execution splits it.  A NULL key has a bucket too."""
    others = [F.col(f"`{c}`") for c in df.columns if c != key]
    salt = F.pmod(F.xxhash64(*others), F.lit(spread)) if others and spread > 1 else F.lit(0)
    bucket = F.pmod(F.hash(F.col(key)), F.lit(buckets))
    (df.repartition(buckets * max(1, spread), bucket, salt).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(name))
    return df.sparkSession.table(name)


def write_small(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """K2/K3: tiny result tables (one row per step/cohort/feature) as one file."""
    write_table(df.coalesce(1), path, fmt)


def write_json_report(df: DataFrame, path: str) -> None:
    """K4: a report table as JSON lines (nested structs/arrays stay nested)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def report_rows(section: str, df: DataFrame, key_col: str, value_cols) -> DataFrame:
    """K5 building block: turn a small statistic table into (section, key, value) rows."""
    return df.select(F.lit(section).alias("section"), F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in value_cols])).alias("value"))


def write_policy_summary(parts, path: str) -> None:
    """K5: union the (section, key, value) tables and write them as text lines, sorted
    by section and key (a single small file)."""
    from functools import reduce
    allp = reduce(lambda a, b: a.unionByName(b), parts)
    line = F.concat_ws("\t", "section", "key", "value").alias("value")
    allp.orderBy("section", "key").select(line).coalesce(1).write.mode("overwrite").text(path)


def markdown_lines(parts, title: str = "Policy summary") -> DataFrame:
    """K5 as Markdown: a title, then per section a heading and a two-column table of
    its (key, value) rows.  Lines are built with column expressions and ordered by
    (section, position); the inputs are report-sized tables."""
    from functools import reduce
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    spark = rows.sparkSession
    body = rows.select("section", F.lit(3).alias("pos"), "key",
                       F.concat(F.lit("| "), F.col("key"), F.lit(" | "), F.col("value"), F.lit(" |")).alias("line"))
    secs = rows.select("section").distinct()
    heads = (secs.select("section", F.lit(0).alias("pos"), F.lit("").alias("key"),
                         F.concat(F.lit("## "), F.col("section")).alias("line"))
             .unionByName(secs.select("section", F.lit(1).alias("pos"), F.lit("").alias("key"),
                                      F.lit("| key | value |").alias("line")))
             .unionByName(secs.select("section", F.lit(2).alias("pos"), F.lit("").alias("key"),
                                      F.lit("| --- | --- |").alias("line"))))
    top = spark.range(1).select(F.lit("").alias("section"), F.lit(0).alias("pos"), F.lit("").alias("key"),
                                F.lit(f"# {title}").alias("line"))
    return top.unionByName(heads).unionByName(body)


def write_markdown(parts, path: str, title: str = "Policy summary") -> None:
    """K5: write the Markdown report as one small text file."""
    md = markdown_lines(parts, title)
    md.orderBy("section", "pos", "key").select("line").coalesce(1).write.mode("overwrite").text(path)
