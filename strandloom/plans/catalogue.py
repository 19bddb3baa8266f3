"""All queries over the driver's tables and the SQL that says the same, gathered from the modules of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: name -> (query, oracle SQL or None); the modules below add to it.
_ALL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a query under its Op-ID and name, with its oracle."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in _ALL:
            raise ValueError(f"two queries are called {name}")
        _ALL[name] = (f, sql)
        return f

    return add


def _load() -> None:
    from strandloom.plans import intervals, more, reads, statistics, streams, tables, windows  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: f for name, (f, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
