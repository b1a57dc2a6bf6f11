"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None).

Keys are the inventory id in lower case plus a word (``k07_served_by_type``),
driver tables only; the survey role tables are prefixed as CTEs.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldbook.plans.roles_sql import with_roles

QueryFn = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

PLAN_MODULES = ("atomic", "joins", "aggregates", "explore", "repair", "survey", "audit", "planning", "checks")


def register(name: str, sql: str | None = None):
    """Decorator: register a query under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, with_roles(sql) if sql else None)
        return fn
    return deco


def _load() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(f"fieldbook.plans.{m}")


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
