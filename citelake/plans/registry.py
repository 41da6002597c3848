"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from citelake.plans import coverage, files, integrity

MODULES = [integrity, coverage, files]


def queries() -> dict[str, Callable]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
