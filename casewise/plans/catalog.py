"""Query registry used by ``__spark_entry__`` and ``bench.py``."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ["q_sources", "q_columns", "q_profile", "q_stats", "q_sampling",
            "q_features", "q_metrics", "q_neighbors", "q_models", "q_scoring", "q_streaming", "q_sinks"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"casewise.plans.{m}")
