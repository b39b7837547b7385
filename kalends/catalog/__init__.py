"""Registered queries, each next to the SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

_MODULES = (
    "functions", "checks", "joins", "aggregates", "indices", "windows", "completion", "backtest", "vintage", "forecast", "weights", "ingest", "audit",

)


def query(name: str, sql: str | None = None):
    """Register a callable ``(spark, sf_dir) -> DataFrame`` and its SQL."""

    def register(function: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
