"""Registry of every planned key: Spark plan + DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortkit.plans import connectors, explorations, extracts, handoffs, learners, notes, reports, rhythms, sequences, training

_MODULES = [reports, explorations, extracts, sequences, notes, training, handoffs, rhythms, connectors, learners]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(getattr(m, "SQL", {}))
    return out
