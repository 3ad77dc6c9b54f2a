"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.tables import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

Build = Callable[[Tables], DataFrame]


def query(sql: str | None = None, digits: int | Mapping[str, int] = 6, views: Mapping[str, str] | None = None,
          name: str | None = None) -> Callable[[Build], Build]:
    """Register a query under its function name, with its oracle if there is one.

    Both sides round floating point columns to ``digits``. ``digits`` may map
    single columns to their own number, with the rest under ``"*"``.
    """
    def register(build: Build) -> Build:
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: comparable(build(Tables(spark, folder)), digits)
        if sql is not None:
            ORACLES[key] = with_views(sql, dict(views or {}))
        return build
    return register


def comparable(df: DataFrame, digits: int | Mapping[str, int]) -> DataFrame:
    """Plain column types for the comparison: rounded doubles, times and lists as text."""
    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            places = digits if isinstance(digits, int) else digits.get(field.name, digits.get("*", 6))
            column = F.round(column.cast("double"), places)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, "|")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])
