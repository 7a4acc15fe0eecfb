"""The registry of queries with their SQL, and the columns that several of them derive from keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name, with SQL for the same rows if there is any."""

    def register(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of literals."""
    return spark.createDataFrame(rows, schema)


def lon(k: Column) -> Column:
    return F.lit(-139.4995) + (k * 7919 % 26000) / 1000.0


def lat(k: Column) -> Column:
    return F.lit(47.5005) + (k * 104729 % 13000) / 1000.0


def lon_sql(k: str) -> str:
    return f"(-139.4995 + ({k} * 7919 % 26000) / 1000.0)"


def lat_sql(k: str) -> str:
    return f"(47.5005 + ({k} * 104729 % 13000) / 1000.0)"
