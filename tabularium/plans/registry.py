"""All registered queries with their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

MODULES = ("usage", "listings", "statistics", "models", "text", "vectors", "words")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"tabularium.plans.{name}"), attribute)
        overlap = merged.keys() & part.keys()
        if overlap:
            raise ValueError(f"query registered twice: {sorted(overlap)}")
        merged |= part
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
