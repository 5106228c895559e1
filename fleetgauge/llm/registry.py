"""The registered queries of this subpackage and their checking SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["minhash", "packing", "line_dedup", "quality_qda", "quality_rules", "vector_search", "mixing", "token_files", "html_main_text", "pitman_yor", "repeated_windows", "filter_audit", "source_divergence"]


def _loaded():
    return [import_module(f"fleetgauge.llm.{m}") for m in _MODULES]


def queries() -> dict:
    return {name: fn for module in _loaded() for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _loaded() for name, sql in module.ORACLE.items()}
