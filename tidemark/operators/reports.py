"""Data-quality reports over a delivered table.

Each report counts per foreign key *before* it meets the parent table, so the
join sees one row per distinct key and a hot parent cannot make a hot task.
Ordering is left to the caller's ``orderBy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.conform import among, lookup, orphans
from tidemark.operators.quality import dup_keys


def _per_key(child: DataFrame, fk: str) -> DataFrame:
    return child.groupBy(fk).agg(F.count(F.lit(1)).alias("_rows"))


def count_by_parent(child: DataFrame, parent: DataFrame, fk: str, pk: str, name: str) -> DataFrame:
    """Rows per (parent id, parent name), children without a parent included."""
    named = lookup(_per_key(child, fk), parent, {fk: pk}, {name: "parent_name"})
    return named.groupBy(fk, "parent_name").agg(F.sum("_rows").alias("total"))


def unexpected_parents(child: DataFrame, fk: str, expected: Sequence) -> DataFrame:
    """Rows per parent id outside the expected list."""
    return among(child, fk, expected, negate=True).groupBy(fk).agg(F.count(F.lit(1)).alias("total"))


def orphan_counts(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows per parent id that is NULL or unknown."""
    return orphans(_per_key(child, fk), parent, fk, pk).withColumnRenamed("_rows", "total")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Composite keys that occur more than once; incomplete keys are left out."""
    return dup_keys(df.dropna(subset=list(keys)), keys)


def shared_values(df: DataFrame, value: str, by: str) -> DataFrame:
    """Values found under more than one ``by``.

    The exact distinct count is planned as (value, by) first and value second,
    so a hot value is spread over its distinct partners.
    """
    return (
        df.dropna(subset=[value, by])
        .groupBy(value)
        .agg(F.count_distinct(F.col(by)).alias("parents"))
        .where(F.col("parents") > 1)
    )



def distinct_sketches(df: DataFrame, by: Sequence[str], value: str, lg_registers: int = 12) -> DataFrame:
    """``by`` and ``sketch``, which counts the different values of ``value``; missing values do not count.

    Sketches are small and can be united, so those of a day may be kept and later cycles
    need not read its rows again. With 2^12 registers the standard error is 1.6 %.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(lg_registers)).alias("sketch"))


def united_distincts(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and ``distinct_values``, estimated from all sketches of a group; a sketch that comes twice counts once."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("distinct_values"))
