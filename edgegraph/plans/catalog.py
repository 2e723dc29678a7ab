"""Registry of queries ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL or None)``."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

_MODULES = ("patterns", "transforms", "aggregates", "snapshots", "windows", "degree_dist",
            "components", "triangles", "paths", "summaries", "estimators", "matching")
_loaded = False


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load() -> None:
    global _loaded
    if _loaded:
        return
    for m in _MODULES:
        importlib.import_module(f"edgegraph.plans.q_{m}")
    _loaded = True


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
