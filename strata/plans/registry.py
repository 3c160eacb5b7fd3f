"""Query registry: every user-facing query is a ``(spark, sf_dir) -> DataFrame``
callable, optionally paired with the DuckDB SQL that computes the same rows over the
same parquet tables (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with its oracle ``sql`` (None = rows-only check)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql.strip() if sql else None)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module so their ``@query`` decorators run."""
    import importlib
    import pkgutil

    import strata.plans as plans

    for mod in pkgutil.iter_modules(plans.__path__):
        if mod.name.startswith("q_"):
            importlib.import_module(f"strata.plans.{mod.name}")
    return QUERIES
