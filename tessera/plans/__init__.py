"""Named queries and their SQL, collected from the modules of this package."""

from __future__ import annotations

from tessera.plans import catalogue, corpus, coverage, derived, matrix, more, names, quality, resolve, spatial

_MODULES = (corpus, catalogue, coverage, derived, matrix, more, names, quality, resolve, spatial)


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
