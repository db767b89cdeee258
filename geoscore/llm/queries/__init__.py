"""Registered queries of the document and vector operators."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all():
    import corpus_pipeline
    from geoscore.llm.queries import documents  # noqa: F401
    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
    return QUERIES, ORACLES
