"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 8


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """One integer width, and doubles rounded, so that results compare across engines."""

    def cast(field):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return (F.round(col, digits) + F.lit(0.0)).alias(field.name)
        return col

    return df.select(*[cast(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(function):
        QUERIES[name] = lambda spark, sf: tidy(function(spark, sf), digits)
        QUERIES[name].__doc__ = function.__doc__
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def rnd(expression: str, alias: str, digits: int = DIGITS) -> str:
    """SQL twin of the rounding in :func:`tidy`."""
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0 AS {alias}"
