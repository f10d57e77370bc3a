"""All queries over the driver's tables, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandloom.plans import formats, further, relational, similarity, structure

_ALL = {**similarity.QUERIES, **relational.QUERIES, **structure.QUERIES, **formats.QUERIES, **further.QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _ALL.items() if sql}
