"""Helpers shared by the training-data operators.

* ``table`` reads a driver table with Spark's reader, so any path Spark knows works.
* ``shared_dir`` is the folder all executors see (``spark.checkpoint.dir``).
* ``shuffles_removed`` frees the disk of finished jobs.
* ``text_batches`` walks Arrow batches in slices of bounded size.
* ``connected_components`` labels graph nodes with alternating star contractions.
* ``chunked_rank`` numbers rows of a group from 0 without one task per group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: The white space of every contract: space and U+0009 to U+000D, as bytes and as text.
WS_BYTES = b" \t\n\x0b\x0c\r"
WS_TEXT = WS_BYTES.decode()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: later jobs
    re-read files instead of re-running the plan, also after an executor is lost."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a job's shuffle files are removed once the table written from them is there.
    The session's own setting returns afterwards."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_batches(batches: Iterator[pa.RecordBatch], column: int, max_rows: int = 512,
                 max_bytes: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches, each of at most ``max_rows`` rows and about ``max_bytes``
    of the given binary/string column (one longer row makes a slice of its own), with
    that column as a list of bytes (None for null)."""
    for batch in batches:
        start, n = 0, batch.num_rows
        if not n:
            continue
        col = batch.column(column).cast(pa.large_binary())
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        while start < n:
            end, total = start, 0
            while end < n and end - start < max_rows and (end == start or total + sizes[end] <= max_bytes):
                total += sizes[end]
                end += 1
            yield batch.slice(start, end - start), col.slice(start, end - start).to_pylist()
            start = end


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns u, v), root the smallest
    node of the component.  Alternates large-star and small-star contractions; each
    round is two aggregates and two joins over the edge table, which is checkpointed
    per round, and the edge set only shrinks towards one star per component.  Nothing
    is collected but two numbers per round."""

    checkpoint_dir(edges.sparkSession)

    def fixed(e: DataFrame) -> tuple[DataFrame, tuple]:
        e = e.checkpoint()
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        return e, (row[0], row[1])

    e = (edges.where("u <> v")
         .select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct())
    e, state = fixed(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        # large star: every larger neighbour of a goes to the smallest of a's neighbourhood
        both = e.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionAll(
            e.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        m = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(m, "a").where("b <> m")
                 .select(F.col("b").alias("hi"), F.col("m").alias("lo")).distinct())
        # small star: the smaller neighbours of a, and a, go to the smallest of them
        m = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(m, "hi").select(
            F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                              F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")))).alias("s"))
            .select("s.hi", "s.lo").where("hi <> lo").distinct())
        e, new = fixed(small)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("connected components did not settle")
    return (e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            .unionAll(e.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct())


def chunked_rank(df: DataFrame, group: list[str], chunk: Column, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: a gapless number from 0 within ``group`` in the order (chunk, *order).
    ``chunk`` deals a group's rows into many parts; each part is numbered by itself and
    shifted by the sizes of the parts before it, so no task holds a whole group and only
    part sizes meet in one place.  The number is the plain rank over ``order`` wherever
    ``chunk`` rises with ``order``."""
    from pyspark.sql import Window

    part, off = f"__part_{name}", f"__off_{name}"
    df = df.withColumn(part, chunk)
    sizes = df.groupBy(*group, part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(off))
    within = Window.partitionBy(*group, part).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(within) - 1)
    return (ranked.join(offsets, [*group, part])
            .withColumn(name, (F.col(name) + F.col(off)).cast("long")).drop(part, off))


def _file_system(path: str):
    import re

    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def put_file(path: str, data: bytes) -> None:
    """Writes a file of the shared folder from a task.  It is written under a name of its own
    and then moved, so a second attempt of a task never shows half a file."""
    system, p = _file_system(path)
    system.create_dir(p.rpartition("/")[0], recursive=True)
    own = f"{p}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(own) as out:
        out.write(data)
    system.move(own, p)


def get_file(path: str) -> bytes:
    system, p = _file_system(path)
    with system.open_input_stream(p) as f:
        return f.read()
