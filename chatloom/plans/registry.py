"""All queries of the library outside the optional subpackages."""

from __future__ import annotations

from chatloom.plans import archive, dataset, general, responses, profiles

MODULES = [archive, dataset, profiles, responses, general]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
