"""Registry of queries and their SQL counterparts, and the SQL views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASOF = "2024-01-31 00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, sql: str, *needs: str) -> None:
    """Named SQL view that oracle queries may start from."""
    if name in VIEWS:
        raise ValueError(f"view {name} is defined twice")
    VIEWS[name] = (sql, needs)


def with_views(sql: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for inner in VIEWS[name][1]:
            add(inner)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in ordered) + "\n" + sql


def flat(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates and times as text and doubles rounded, so that both engines print the same values."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DoubleType):
            col = F.round(col, digits)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, *needs: str, digits: int = 6):
    """Register a query; ``sql`` may start from the named views."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: flat(fn(spark, sf_dir), digits)
        if sql:
            ORACLES[name] = with_views(sql, *needs)
        return fn
    return register
