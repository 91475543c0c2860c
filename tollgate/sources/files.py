"""File sources of the reference's inputs (S1-S6), with declared schemas.

Count tables arrive as folders of CSV files; scoring requests as CSV, JSON objects or
``{"citizens": [...]}`` arrays.  CSV columns are bound by header name, whatever their order.
Readers are plain ``spark.read`` calls with declared types (no inference pass over the
data); the driver only lists files and reads their header lines, through Hadoop's file systems.
"""

from __future__ import annotations

import csv
import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

ENROLMENT_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()), T.StructField("pincode", T.LongType()),
    T.StructField("age_18_greater", T.LongType())])
BIOMETRIC_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()), T.StructField("pincode", T.LongType()),
    T.StructField("bio_age_17_", T.LongType())])
DEMOGRAPHIC_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()), T.StructField("pincode", T.LongType()),
    T.StructField("demo_age_17_", T.LongType())])
INDIVIDUAL_SCHEMA = T.StructType([
    T.StructField("aadhaar_id", T.StringType()), T.StructField("enrolment_date", T.TimestampType()),
    T.StructField("state", T.StringType()), T.StructField("district", T.StringType()),
    T.StructField("pincode", T.LongType()), T.StructField("urban_rural", T.StringType()),
    T.StructField("dob", T.TimestampType()), T.StructField("gender", T.StringType()),
    T.StructField("biometric_updates_count", T.DoubleType()),
    T.StructField("demographic_updates_count", T.DoubleType())])
BIOMETRIC_LOG_SCHEMA = T.StructType([
    T.StructField("aadhaar_id", T.StringType()), T.StructField("update_date", T.TimestampType())])
DEMOGRAPHIC_LOG_SCHEMA = T.StructType([
    T.StructField("aadhaar_id", T.StringType()), T.StructField("update_date", T.TimestampType()),
    T.StructField("update_type", T.StringType())])
SCORE_REQUEST_SCHEMA = T.StructType([
    T.StructField("aadhaar_id", T.StringType()), T.StructField("gender", T.StringType()),
    T.StructField("state", T.StringType()), T.StructField("district", T.StringType()),
    T.StructField("urban_rural", T.StringType()), T.StructField("eighteenth_birthday", T.DateType()),
    T.StructField("enrolment_date", T.DateType()), T.StructField("pincode", T.LongType())])


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system): works for every store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    p, fs = _file_system(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(p) or [] if x.isFile())


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a CSV file: its first line, read through Hadoop's codecs."""
    p, fs = _file_system(spark, path)
    jvm, stream = spark._jvm, fs.open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    names = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
    return tuple(n.strip() for n in names)


def csv_by_name(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """CSV files with header rows, columns bound by *name* to ``schema``.

    Files are grouped by their header, so one scan reads all files of a layout.  Columns
    of the schema that a file lacks are NULL, further columns are ignored.  ``_corrupt``
    keeps the raw line of rows with too few or too many fields, and the joined fields of rows with
    a value that does not parse as its column's type (that value is NULL)."""
    layouts: dict[tuple, list[str]] = {}
    for p in paths:
        layouts.setdefault(_header(spark, p), []).append(p)
    parts = []
    for names, files_ in layouts.items():
        # raw names by position: a header may repeat a name (the first one counts)
        raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
                           + [T.StructField("_corrupt", T.StringType())])
        df = (spark.read.schema(raw).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt").csv(files_))
        cols, bad = [], F.lit(False)
        for f in schema.fields:
            if f.name not in names:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            text = F.col(f"c{names.index(f.name)}")
            value = text if isinstance(f.dataType, T.StringType) else F.trim(text).try_cast(f.dataType)
            bad = bad | (value.isNull() & (F.trim(text) != ""))
            cols.append(value.alias(f.name))
        line = F.concat_ws(",", *[F.coalesce(F.col(f"c{i}"), F.lit("")) for i in range(len(names))])
        flagged = F.coalesce("_corrupt", F.when(F.coalesce(bad, F.lit(False)), line))
        parts.append(df.select(*cols, flagged.alias("_corrupt")))
    return reduce(DataFrame.unionByName, parts)


def csv_folder(spark: SparkSession, folder: str, schema: T.StructType,
               filenames=None) -> DataFrame:
    """All ``*.csv`` of a folder (or the named ones), unioned by column name.

    Named files that do not exist are skipped with a warning; no file at all raises.
    """
    paths: list[str] = []
    for f in filenames or ["*.csv"]:
        found = _matching(spark, f"{folder.rstrip('/')}/{f}")
        if not found and filenames:
            log.warning("file not found, skipped: %s", f)
        paths += found
    if not paths:
        raise FileNotFoundError(f"no CSV files in {folder}" if filenames is None
                                else f"none of the named files exist in {folder}")
    return csv_by_name(spark, paths, schema)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not, with their raw line)."""
    return df.where(F.col("_corrupt").isNull()).drop("_corrupt"), df.where(F.col("_corrupt").isNotNull())


def load_enrolment(spark, folder, filenames=None) -> DataFrame:
    return csv_folder(spark, folder, ENROLMENT_SCHEMA, filenames)


def load_biometric(spark, folder, filenames=None) -> DataFrame:
    return csv_folder(spark, folder, BIOMETRIC_SCHEMA, filenames)


def load_demographic(spark, folder, filenames=None) -> DataFrame:
    return csv_folder(spark, folder, DEMOGRAPHIC_SCHEMA, filenames)


def load_individuals(spark, folder, filenames=None) -> DataFrame:
    """People with their attributes: one row each."""
    return csv_folder(spark, folder, INDIVIDUAL_SCHEMA, filenames)


def load_biometric_log(spark, folder, filenames=None) -> DataFrame:
    """Step events of the biometric step: one row per update."""
    return csv_folder(spark, folder, BIOMETRIC_LOG_SCHEMA, filenames)


def load_demographic_log(spark, folder, filenames=None) -> DataFrame:
    """Step events of the other steps: one row per update, named by ``update_type``."""
    return csv_folder(spark, folder, DEMOGRAPHIC_LOG_SCHEMA, filenames)


def score_requests_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests from a CSV file or folder (header row, columns by name; a value that
    does not parse is NULL, as an absent one)."""
    p, fs = _file_system(spark, path)
    paths = _matching(spark, f"{path.rstrip('/')}/*.csv") if fs.isDirectory(p) else _matching(spark, path)
    if not paths:
        raise FileNotFoundError(f"no CSV files at {path}")
    return csv_by_name(spark, paths, SCORE_REQUEST_SCHEMA).drop("_corrupt")


def score_requests_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per file, or ``{"citizens": [...]}``; both shapes become
    one row per request (``explode`` of the array)."""
    wrapped = T.StructType([T.StructField("citizens", T.ArrayType(SCORE_REQUEST_SCHEMA))]
                           + SCORE_REQUEST_SCHEMA.fields)
    raw = spark.read.schema(wrapped).option("multiLine", True).json(path)
    arr = raw.where(F.col("citizens").isNotNull()).select(F.explode("citizens").alias("r")).select("r.*")
    single = raw.where(F.col("citizens").isNull()).select(*[f.name for f in SCORE_REQUEST_SCHEMA.fields])
    return arr.unionByName(single)
