"""Registered queries over the given tables, each with its check in SQL if there is one."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register `run(spark, folder)`; `sql` gives the same result from the same tables."""

    def register(run: Callable) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def load_all() -> None:
    from vecloom.plans import corpus, reports, texts, vectors  # noqa: F401
