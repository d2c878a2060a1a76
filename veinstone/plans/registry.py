"""queries() and oracle_sql() of the engine's own operators."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("evidence", "discovery", "relations", "texts", "learning", "materials", "dual", "streams")


def _all() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"veinstone.plans.{name}").REGISTRY
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _all().items() if sql}
