"""Queries by name, each with the SQL that states its result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segment_sql(name: str, tag: str, text: str) -> str:
    """SQL for one column of a fingerprint."""
    return f"coalesce('{len(name)}:{name}={tag}' || length({text}) || ':' || {text}, '{len(name)}:{name}=~')"


def fingerprint_sql(**columns: tuple[str, str]) -> str:
    """SQL for a fingerprint over ``name=(tag, text expression)``."""
    parts = [segment_sql(name, *columns[name]) for name in sorted(columns)]
    return "sha256(" + " || ".join(parts) + ")"
