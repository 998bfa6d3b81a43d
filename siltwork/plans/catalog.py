"""Registered queries over the driver's tables and their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("corpus", "index", "stores")


def queries() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"siltwork.plans.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"siltwork.plans.{m}").ORACLES.items()}
