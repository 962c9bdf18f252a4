"""Queries by name, each with the SQL that must give the same rows on another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, DateType, DecimalType, TimestampNTZType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; the result is rendered by ``plain`` before it is compared."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf: plain(fn(spark, sf))
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Render types that engines hand out differently: decimals as double, dates, times and bytes as text."""

    def one(name: str, kind) -> str:
        if isinstance(kind, DecimalType):
            return f"cast(`{name}` AS double) AS `{name}`"
        if isinstance(kind, DateType):
            return f"date_format(`{name}`, 'yyyy-MM-dd') AS `{name}`"
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return f"date_format(`{name}`, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS `{name}`"
        if isinstance(kind, BinaryType):
            return f"lower(hex(`{name}`)) AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[one(f.name, f.dataType) for f in df.schema.fields])
