"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = ["ingest", "cpu", "memory", "disk", "wait", "blocking", "deadlock", "health", "inventory", "chain", "daily", "stream"]


def _loaded():
    return [import_module(f"fleetgauge.plans.{m}_queries") for m in _MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for module in _loaded() for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _loaded() for name, sql in module.ORACLE.items()}
