"""Named queries over the given tables, each with SQL that checks it where SQL can."""

from __future__ import annotations

from importlib import import_module

from flowvec.plans import registry

SECTIONS = ("rows", "search", "changes", "texts", "measurements")


def _load() -> None:
    for section in SECTIONS:
        import_module(f"flowvec.plans.{section}")


def queries():
    _load()
    return {name: registry.bind(build) for name, build in registry.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
