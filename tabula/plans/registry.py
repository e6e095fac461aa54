"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
fixture tables. The oracle is an independent ANSI-SQL statement over the
same tables, with the same output column names.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module (each registers itself on import)."""
    from . import (q_relational, q_window, q_missing, q_encode, q_text,  # noqa: F401
                   q_evaluate, q_sample, q_models, q_stream, q_functions, q_diagnose,
                   q_neighbors)
