"""Keys that are equal under a collation.

Servers often compare text without regard to case, and some also without trailing
blanks. Spark compares columns under a collation itself, in joins, groups and
windows, so values keep their spelling. Only fingerprints need a text that equal
keys share; it is hashed and never delivered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY = "UTF8_BINARY"
# Spark's collations for which ``folded`` gives one text per key.
KEY_COLLATIONS = (BINARY, "UTF8_LCASE", "UTF8_BINARY_RTRIM", "UTF8_LCASE_RTRIM")


def check_collation(collation: str) -> None:
    if collation not in KEY_COLLATIONS:
        raise ValueError(f"key collation {collation!r} is none of {KEY_COLLATIONS}")


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.StringType, T.CharType, T.VarcharType))


def key_column(df: DataFrame, column: str, collation: str = BINARY) -> Column:
    """A column of ``df`` to compare keys by; only text has a collation."""
    value = df[f"`{column}`"]
    return value if collation == BINARY or not is_text(df, column) else F.collate(value.cast("string"), collation)


def comparable(df: DataFrame, columns: Sequence[str], collation: str = BINARY) -> DataFrame:
    """``df`` with its text among ``columns`` declared to be compared under ``collation``; no value changes."""
    if collation == BINARY:
        return df
    return df.withColumns({c: key_column(df, c, collation) for c in columns if is_text(df, c)})


def plain(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the types of ``schema`` again, for columns of the same names."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def folded(value: Column, collation: str = BINARY) -> Column:
    """A text that two texts share if and only if they are equal under ``collation``.

    Both small sigmas count as one letter, which lower-casing a whole text would tell
    apart by their place.
    """
    if collation.endswith("_RTRIM"):
        value = F.rtrim(value)
    if collation.startswith("UTF8_LCASE"):
        value = F.lower(F.translate(value, "Σς", "σσ"))
    return value
