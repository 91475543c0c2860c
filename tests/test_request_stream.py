import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.operators.prep import validate_required
from tollgate.session import scratch_path
from tollgate.sources import files
from tollgate.streaming import requests as R

SCHEMA = T.StructType([T.StructField("entity_id", T.StringType()), T.StructField("gender", T.StringType()),
                       T.StructField("pincode", T.LongType())])


class Plain:
    """Stands for a bundle: refuses rows without a gender, scores the rest by their pincode."""

    def score(self, df):
        return validate_required(df, ["gender"]).select(
            "entity_id", "error", F.when(F.col("error").isNull(), F.coalesce(F.col("pincode"), F.lit(-1))).alias("score"))


def put(folder, name, text):
    # a file appears under its name only when whole
    with open(os.path.join(folder, f".{name}"), "w") as f:
        f.write(text)
    os.rename(os.path.join(folder, f".{name}"), os.path.join(folder, name))


def rows_of(df):
    return sorted(((r["entity_id"], r["error"], r["score"]) for r in df.collect()), key=repr)


MISSING = "Missing required field: gender"


def test_layouts_repeats_and_bad_rows_over_several_runs(spark):
    folder, at = tempfile.mkdtemp(prefix="tollgate-req-"), scratch_path(spark, "req")
    put(folder, "a.csv", "entity_id,gender,pincode\n1,F,10\n2,,20\n1,F,10\n3,M,x\n")
    put(folder, "b.csv", "note,pincode,gender,entity_id\nn,10,F,1\nn,40,M,4\n")  # other order, one more column, a repeat
    put(folder, "c.txt", "not read")
    want = [("1", None, 10), ("2", MISSING, None), ("3", None, -1), ("4", None, 40)]
    assert rows_of(R.run(spark, folder, at, SCHEMA, Plain(), max_files=1)) == want
    assert rows_of(R.run(spark, folder, at, SCHEMA, Plain(), max_files=1)) == want  # nothing new
    put(folder, "d.csv", "pincode,entity_id\n50,5\n")                              # no gender at all
    put(folder, "e.csv", "entity_id,gender,pincode\n1,F,10\n1,F,11\n")              # a repeat and a changed request
    want += [("5", MISSING, None), ("1", None, 11)]
    assert rows_of(R.run(spark, folder, at, SCHEMA, Plain())) == sorted(want, key=repr)


def test_replayed_batch_changes_nothing(spark):
    folder, at = tempfile.mkdtemp(prefix="tollgate-req-"), scratch_path(spark, "req")
    put(folder, "a.csv", "entity_id,gender,pincode\n" + "7,F,70\n" * 500 + "8,M,80\n")  # one hot request
    R.land(spark, folder, at, SCHEMA)
    assert spark.read.parquet(f"{at}/landed/batch-*").count() == 2
    R.score_landed(spark, at, SCHEMA, Plain())
    R.score_landed(spark, at, SCHEMA, Plain())
    want = [("7", None, 70), ("8", None, 80)]
    assert rows_of(spark.read.parquet(f"{at}/scores/batch-*")) == want
    # the same files landed by a second listing: the rows come again, the scores do not
    again = scratch_path(spark, "req")
    R.land(spark, folder, again, SCHEMA)
    spark.read.parquet(f"{again}/landed/batch-*").write.parquet(f"{at}/landed/batch-9")
    R.score_landed(spark, at, SCHEMA, Plain())
    assert rows_of(spark.read.parquet(f"{at}/scores/batch-*")) == want


def test_equals_the_batch_form(spark):
    folder, at = tempfile.mkdtemp(prefix="tollgate-req-"), scratch_path(spark, "req")
    names = [f.name for f in files.SCORE_REQUEST_SCHEMA.fields]
    lines = [f"{i},{'FM'[i % 2] if i % 5 else ''},s,d,Urban,2020-01-0{1 + i % 9},2019-01-01,{i}" for i in range(40)]
    for k in range(4):
        put(folder, f"{k}.csv", ",".join(names) + "\n" + "\n".join(lines[k::4]) + "\n")

    class Gender:
        def score(self, df):
            return validate_required(df, ["gender"]).select("aadhaar_id", "gender", "eighteenth_birthday", "pincode", "error")

    got = R.run(spark, folder, at, files.SCORE_REQUEST_SCHEMA, Gender(), max_files=3)
    batch = Gender().score(files.score_requests_csv(spark, folder))
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() == 40


def test_folder_without_requests_has_no_scores(spark):
    folder, at = tempfile.mkdtemp(prefix="tollgate-req-"), scratch_path(spark, "req")
    with pytest.raises(Exception, match="(?i)path"):
        R.run(spark, folder, at, SCHEMA, Plain())
