"""Deterministic splits, folds, samples and label permutations.

Order = hex md5 of ``seed:key`` (the same text order in every engine).  Ranks inside a
class are taken in parts by the leading hex digits (``ordered.part_ranks``); the number of
digits follows the row count, so a class holding half of all rows is never sorted in one task.

Labels may be of any type.  Rows with a NULL label cannot be stratified: they stay in the
result with a NULL split or fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import md5_order_key
from ..functions.ordered import hex_digits, part_ranks
from ..session import checkpoint_dir


def _ordered(df: DataFrame, key: str, *seeds) -> tuple[DataFrame, int]:
    """``df`` with md5 orders ``__h0``, ``__h1``.. written once (ranks read it several
    times), and the hex digits that cut it into parts."""
    checkpoint_dir(df.sparkSession)
    for i, seed in enumerate(seeds):
        df = df.withColumn(f"__h{i}", md5_order_key(seed, F.col(key)))
    df = df.checkpoint(eager=True)
    return df, hex_digits(df.count())


def class_ranks(df: DataFrame, key: str, label: str, seed) -> DataFrame:
    """Add ``rank_in_class`` (1-based, per label value, in md5 order) and ``__n_class``."""
    h, digits = _ordered(df, key, seed)
    return part_ranks(h, F.col(label), "__h0", "rank_in_class", "__n_class", digits).drop("__h0")


def stratified_split(df: DataFrame, key: str, label: str, seed=42, test_pct: int = 20) -> DataFrame:
    """M1: ``split`` = 'test' for the first ceil(test_pct% of the class) rows of each
    class in md5 order, else 'train'.  Label proportions are kept exactly; NULL labels get
    a NULL split."""
    r = class_ranks(df, key, label, seed)
    n_test = F.floor((F.col("__n_class") * F.lit(test_pct) + F.lit(99)) / F.lit(100))
    side = F.when(F.col("rank_in_class") <= n_test, F.lit("test")).otherwise(F.lit("train"))
    return r.withColumn("split", F.when(F.col(label).isNotNull(), side)).drop("__n_class", "rank_in_class")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed=42) -> DataFrame:
    """M2: ``fold`` = (rank in class - 1) mod k -- every fold keeps class proportions; NULL
    labels get a NULL fold."""
    r = class_ranks(df, key, label, seed)
    fold = ((F.col("rank_in_class") - 1) % F.lit(k)).cast("int")
    return r.withColumn("fold", F.when(F.col(label).isNotNull(), fold)).drop("__n_class", "rank_in_class")


def shuffled_labels(df: DataFrame, key: str, label: str, seed=42) -> DataFrame:
    """A deterministic permutation of the label column: the row ranked i-th by
    md5(seed) receives the label of the row ranked i-th by md5(seed+1).  Both orders are
    read from one written table; equi-join on the rank, no collect."""
    h, digits = _ordered(df.select(key, label), key, seed, f"{seed}+1")
    one = F.lit(1)
    a = part_ranks(h, one, "__h0", "__ra", "__na", digits).select(key, label, "__ra")
    b = part_ranks(h, one, "__h1", "__rb", "__nb", digits).select("__rb", F.col(label).alias("shuffled_label"))
    return a.join(b, F.col("__ra") == F.col("__rb")).drop("__ra", "__rb")


def hash_sample(df: DataFrame, key: str, n: int, seed=42) -> DataFrame:
    """N rows chosen by md5 order (TakeOrderedAndProject: per-partition top-n)."""
    return df.orderBy(md5_order_key(seed, F.col(key)), F.col(key)).limit(n)


def temporal_split(df: DataFrame, ts_col: str, cutoff_year: int) -> Column:
    """Train on anchors before ``cutoff_year``, test on the later ones; NULL without anchor."""
    year = F.year(F.col(ts_col))
    return F.when(year < F.lit(cutoff_year), F.lit("train")).when(year >= F.lit(cutoff_year), F.lit("test"))
