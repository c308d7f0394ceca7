"""Collects the queries and their oracle SQL from the query modules."""

from __future__ import annotations

import importlib

MODULES: tuple[str, ...] = ("q_genetics", "q_tables", "q_results", "q_more", "q_sources")


def _gather(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"genoframe.plans.{name}"), attribute)
        clash = found.keys() & part.keys()
        if clash:
            raise ValueError(f"query names registered twice: {sorted(clash)}")
        found.update(part)
    return found


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("ORACLES")
