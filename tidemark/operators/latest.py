"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.collation import BINARY, key_column


def newest_first(*columns: str) -> list[Column]:
    """Descending order with missing values last."""
    return [F.col(c).desc_nulls_last() for c in columns]


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], collation: str = BINARY
) -> DataFrame:
    """One row per ``keys``, equal under ``collation``: the first under ``order`` (names mean newest first).

    ``row_number() = 1`` is planned as a WindowGroupLimit on both sides of the
    shuffle, so a map task sends at most one row per key: a key holding a third
    of the table costs its reducer one row per map task.
    """
    ordering = [o if isinstance(o, Column) else F.col(o).desc_nulls_last() for o in order]
    window = Window.partitionBy(*[key_column(df, k, collation) for k in keys]).orderBy(*ordering)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")
