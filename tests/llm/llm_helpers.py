"""Small inputs shared by the training-data tests."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def documents(spark, rows, extra=True):
    """(doc_id, text) rows as a documents table with further columns, some with names that
    operators use inside."""
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        df = df.selectExpr("doc_id", "text", "'en' AS lang", "'src0' AS source",
                           "length(text) AS n_chars", "1 AS fp", "'x' AS bucket", "true AS kept")
    return df


def put(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
