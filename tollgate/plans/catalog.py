"""Registry of named queries (Spark) and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``.  ``finalize`` normalises the output
for comparison: doubles rounded to 6 digits, timestamps as TIMESTAMP_NTZ (DuckDB's
naive TIMESTAMP).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` with an optional oracle SQL."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import apply_runtime_conf
            apply_runtime_conf(spark)
            return finalize(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so that its queries register themselves."""
    from . import (q_cascade, q_features, q_metrics, q_models, q_prep,  # noqa: F401
                   q_stream)
