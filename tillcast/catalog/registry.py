"""Registry of named queries: Spark builder + DuckDB oracle SQL side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(f: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = f
        if sql is not None:
            ORACLE[key] = sql
        return f
    return deco


def rounded(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (float sums differ in the last bits between engines)."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def sql_round(body: str, cols: dict[str, int] | list[str], digits: int = 6) -> str:
    """Oracle side of ``rounded``: ``SELECT * REPLACE (round(c, n) AS c ...)``."""
    if isinstance(cols, dict):
        items = cols.items()
    else:
        items = [(c, digits) for c in cols]
    rep = ", ".join(f"round({c}, {n}) AS {c}" for c, n in items)
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) __q"
