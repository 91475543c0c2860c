"""Names, queries and oracle SQL of the training-data operators."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = ("op1_topk", "op2_simhash", "op3_mixing", "op4_chat", "op5_quality", "op6_wavelet", "op7_bpe", "op8_license", "op9_lines", "op10_sharding", "op11_negatives", "op12_phrases",
           "op13_repeats")


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` as query ``name`` with its DuckDB SQL."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
