"""Corpus pipeline over ``documents``: quality rules, line dedup, SimHash near-dedup, mixing
to target weights, BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet to the shared folder and reads back as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``; extra
columns travel along.  Each stage works on all rows its predecessor kept.

Defined cases: null texts have no words and go in the first stage; a document that line dedup
empties stays with an empty text, and all of these are one group for the near-dedup; a rate
above one repeats a document, a rate of zero drops it; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import op2_simhash, op3_mixing, op5_quality, op7_bpe, op9_lines
from tollgate.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return op5_quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from every text; n_chars follows."""
    return op9_lines.drop_lines(spark, docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return op2_simhash.one_per_component(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says, so that domain tokens meet their targets."""
    return op3_mixing.mixed(spark, docs, table(spark, sf_dir, "labels"))


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of every document left."""
    return op7_bpe.encoded(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_near_dedup),
          ("mixing to target weights", mix_sources), ("BPE", bpe_codec)]

#: BPE ids and trained posteriors cannot be expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
