"""All queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("near_dedup", "sharding", "secrets", "rollup", "quality", "substrings", "decontam", "url_filter", "toxicity", "mixing", "alignment", "licenses", "ranked")


def queries() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"siltwork.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"siltwork.llm.{m}").ORACLES.items()}
