"""Registry of checkable queries: each binds an operator to the fixture tables
and pairs it with an independent DuckDB SQL oracle (or none, for model-based
or random results).

Spark results pass through ``finish``: double columns are rounded at 6
decimals the same way the oracle rounds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartograph.functions.scalars import round6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(df[f.name]).alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: finish(_fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all_queries() -> None:
    """Import the modules that register queries."""
    from cartograph.plans import (queries_core, queries_eda, queries_ml, queries_quality,  # noqa: F401
                                  queries_sources, queries_store)
