"""Registration of queries, and how their results are put into comparable columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Texts for instants, dates and arrays; 64-bit numbers."""
    columns = []
    for field in df.schema:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",", "NULL")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(kind, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register a query under its key, with the SQL that checks it."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _queries[name] = run
        if sql is not None:
            _sql[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
