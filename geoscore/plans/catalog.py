"""Registry of the stand-in queries and their DuckDB oracles.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
driver tables and exercises one group of library operators. The oracle is
plain SQL over the same tables; numeric outputs are rounded on both sides
so the comparison does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
NOTES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, note: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        if note:
            NOTES[name] = note
        return fn
    return deco


def R(expr: str, n: int) -> str:
    """DuckDB rounding with Spark's ``round`` semantics on doubles: half away
    from zero on the shortest decimal form (the form PostgreSQL's
    ``x::numeric`` also uses)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"
