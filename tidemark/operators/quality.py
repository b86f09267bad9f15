"""Checks on columns, keys and references."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.collation import BINARY, key_column


class ConformanceError(ValueError):
    """A snapshot breaks a rule and must not be delivered."""


def canonical_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Key names in the spelling of the data; a missing key is an error."""
    if not keys:
        raise ConformanceError("no key columns are configured")
    spelling = {c.lower(): c for c in df.columns}
    missing = [k for k in keys if k.lower() not in spelling]
    if missing:
        raise ConformanceError(f"key columns {missing} are not among {df.columns}")
    return [spelling[k.lower()] for k in keys]


def assert_uniform(frames: Iterable[DataFrame]) -> None:
    """Several extracts for one target must offer the same columns."""
    shapes = [tuple(sorted(c.lower() for c in df.columns)) for df in frames]
    if len(set(shapes)) > 1:
        raise ConformanceError(f"extracts differ in their columns: {sorted(set(shapes))}")


def assert_absent(df: DataFrame, column: str | None) -> None:
    """``column`` is generated elsewhere and must not be supplied."""
    if column and column.lower() in {c.lower() for c in df.columns}:
        raise ConformanceError(f"column {column!r} is reserved; rename it in the extract")


def assert_origin_column(origin_col: str | None, auto_id: str | None) -> None:
    if origin_col and auto_id and origin_col.lower() == auto_id.lower():
        raise ConformanceError("the origin column and the generated id cannot be the same")


def assert_subset(df: DataFrame, target_columns: Iterable[str], protected: Iterable[str] = ()) -> None:
    """Only target columns, and none of the protected ones."""
    have = {c.lower() for c in df.columns}
    unknown = have - {c.lower() for c in target_columns}
    if unknown:
        raise ConformanceError(f"columns {sorted(unknown)} do not exist in the target")
    touched = have & {c.lower() for c in protected}
    if touched:
        raise ConformanceError(f"columns {sorted(touched)} must not be written")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any key column. A scan and a filter, no shuffle."""
    return df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def dup_keys(df: DataFrame, keys: Sequence[str], collation: str = BINARY) -> DataFrame:
    """Keys that occur more than once, with their count.

    Only the key columns are read, and counts are combined before the shuffle. Of
    spellings that are equal under ``collation`` the smallest stands for all.
    """
    counted = F.count(F.lit(1)).alias("repetitions")
    if collation == BINARY:
        return df.groupBy(*keys).agg(counted).where(F.col("repetitions") > 1)
    same = [key_column(df, k, collation).alias(f"_key_{i}") for i, k in enumerate(keys)]
    groups = df.groupBy(*same).agg(F.min(F.struct(*[F.col(f"`{k}`") for k in keys])).alias("_spelled"), counted)
    return groups.where(F.col("repetitions") > 1).select("_spelled.*", "repetitions")


def assert_no_rows(violations: DataFrame, message: str) -> None:
    """Run the check now. A check left inside an unused column would be pruned."""
    sample = violations.limit(5).collect()
    if sample:
        raise ConformanceError(f"{message}: {[r.asDict() for r in sample]}")
