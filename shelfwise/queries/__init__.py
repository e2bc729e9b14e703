"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SECTIONS = (
    "scans",
    "filters",
    "lookups",
    "aggregates",
    "windows",
    "texts",
    "numbers",
    "markup",
    "encoding",
    "charts",
    "streams",
    "jobs",
)


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    for section in SECTIONS:
        importlib.import_module(f"shelfwise.queries.{section}")
