"""All registered queries of the core."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import features, pipelines, problems, records, stores, tables

_MODULES = (features, tables, records, problems, pipelines, stores)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _MODULES:
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out |= m.SQL
    return out
