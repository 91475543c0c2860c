"""Scoring requests that arrive as CSV files.

A stream of a CSV source binds columns by position, and files of one folder may order their columns
differently.  So two streams run one after the other, each with a checkpoint of its own:

1. ``land``: a stream of file *names*; each micro-batch reads its files by header name
   (``files.csv_by_name``) and writes them, with the landing time, under its batch id.
2. ``score_landed``: a stream of the landed rows.  ``dropDuplicatesWithinWatermark`` lets a request through
   once, however often it is repeated within ``delay``; what is left is scored by the batch function.

A replayed micro-batch replaces its own folder.  Repeats are equal in every column of the schema and in the
line of a row that did not parse; equal requests of one micro-batch are merged before the shuffle, so a request
repeated a million times costs a row a task.  A row without a required field keeps its ``error``; a value
that does not parse is NULL, as in the batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files

#: Columns of Spark's file listing source; the content is never read.
LISTING = "path string, modificationTime timestamp, length long, content binary"
LANDED_AT, LINE = "landed_at", "corrupt_line"


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def landed_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with the landing time and the line of a row that did not parse."""
    return T.StructType([*schema.fields, T.StructField(LINE, T.StringType()), T.StructField(LANDED_AT, T.TimestampType())])


def land(spark: SparkSession, folder: str, at: str, schema: T.StructType, max_files: int = 1000) -> None:
    """All CSV files of ``folder`` not yet landed, ``max_files`` a micro-batch, into ``at``.  The driver holds
    the names and header lines of one micro-batch's files."""
    names = (spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", "*.csv")
             .option("maxFilesPerTrigger", max_files).load(folder).select("path"))

    def put(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())
        if not paths:
            return
        rows = files.csv_by_name(batch.sparkSession, paths, schema).withColumnRenamed("_corrupt", LINE)
        (rows.dropDuplicates().withColumn(LANDED_AT, F.current_timestamp())
         .write.mode("overwrite").parquet(f"{at}/landed/batch-{batch_id}"))

    _finish(names.writeStream.foreachBatch(put).option("checkpointLocation", f"{at}/land-ckpt")
            .trigger(availableNow=True).start())


def requests_once(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """Every request of a stream of landed rows the first time it is seen within ``delay``."""
    keys = [c for c in rows.columns if c != LANDED_AT]
    return rows.withWatermark(LANDED_AT, delay).dropDuplicatesWithinWatermark(keys)


def score_landed(spark: SparkSession, at: str, schema: T.StructType, bundle, prepare=lambda df: df,
                 delay: str = "1 day") -> None:
    """Scores what ``land`` wrote into ``at`` since the last run; ``prepare`` names key and anchor as the bundle
    expects them.  Each micro-batch's scores are written under its id."""
    rows = spark.readStream.schema(landed_schema(schema)).parquet(f"{at}/landed/batch-*")

    def put(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # the scored and the refused rows are two branches
        try:
            bundle.score(prepare(kept)).write.mode("overwrite").parquet(f"{at}/scores/batch-{batch_id}")
        finally:
            kept.unpersist()

    _finish(requests_once(rows, delay).writeStream.foreachBatch(put).outputMode("append")
            .option("checkpointLocation", f"{at}/score-ckpt").trigger(availableNow=True).start())


def run(spark: SparkSession, folder: str, at: str, schema: T.StructType, bundle, prepare=lambda df: df,
        delay: str = "1 day", max_files: int = 1000) -> DataFrame:
    """Lands and scores what is new in ``folder``; returns the scores of all runs with the same ``at``.
    Raises while no file has ever arrived."""
    land(spark, folder, at, schema, max_files)
    score_landed(spark, at, schema, bundle, prepare, delay)
    return spark.read.parquet(f"{at}/scores/batch-*")
