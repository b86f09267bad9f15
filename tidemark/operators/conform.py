"""Lookups, filters, origin tags and projection to a target schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.collation import BINARY, key_column
from tidemark.operators.quality import assert_absent, assert_uniform


def project(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Select exactly the target columns, each from a name or an expression."""
    return df.select(
        *[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in mapping.items()]
    )


def require(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows for which every predicate is true (NULL counts as false)."""
    return df.where(reduce(lambda a, b: a & b, predicates))


def among(df: DataFrame, column: str, values: Sequence, negate: bool = False) -> DataFrame:
    """IN / NOT IN against a literal list; NULL is never listed nor unlisted."""
    inside = F.col(column).isin(list(values))
    return df.where(F.col(column).isNotNull() & (~inside if negate else inside))


def lookup(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str], collation: str = BINARY
) -> DataFrame:
    """Left outer lookup: ``on`` maps fact column -> dim column, ``take`` dim column -> new name.

    No broadcast hint: Spark broadcasts the lookup table when its measured size
    is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges,
    where AQE splits a hot foreign key on the fact side. A repeated lookup id
    multiplies rows, as an outer join does; check it with ``dup_keys``. Ids that are
    text meet under ``collation``.
    """
    picked = dim.select(
        *[F.col(d).alias(f"_on_{d}") for d in on.values()],
        *[F.col(d).alias(name) for d, name in take.items()],
    )
    condition = [key_column(df, fact, collation) == key_column(picked, f"_on_{d}", collation) for fact, d in on.items()]
    return df.join(picked, condition, "left").drop(*[f"_on_{d}" for d in on.values()])


def with_parent(child: DataFrame, parent: DataFrame, fk: str, pk: str, take: Mapping[str, str]) -> DataFrame:
    """Child rows with columns of their parent, NULL where there is none."""
    return lookup(child, parent, {fk: pk}, take)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose key is NULL or has no parent."""
    known = parent.select(F.col(pk).alias("_pk"))
    return child.join(known, child[fk] == known["_pk"], "left_anti")


def having_parent(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows that have a parent."""
    known = parent.select(F.col(pk).alias("_pk"))
    return child.join(known, child[fk] == known["_pk"], "left_semi")


def guard_source(df: DataFrame, identity: DataFrame, column: str, expected) -> DataFrame:
    """No rows at all unless ``identity`` holds ``expected``.

    The test becomes a scalar subquery, evaluated once: no join, no shuffle of ``df``.
    """
    return df.where(identity.where(F.col(column) == F.lit(expected)).exists())


def tag_origin(df: DataFrame, name: str, origin_col: str | None, auto_id: str | None = None) -> DataFrame:
    """Add the origin name; the tag joins the key of the job."""
    assert_absent(df, auto_id)
    if not origin_col:
        return df
    assert_absent(df, origin_col)
    return df.withColumn(origin_col, F.lit(name))


def origin_column(include: bool, setting: str | None, several_jobs: bool, default: str = "row_origin") -> str | None:
    """Name of the origin column, None when rows are not tagged.

    A blank ``setting`` switches tagging off; no setting tags only when there
    are several jobs.
    """
    if not include:
        return None
    if setting is not None:
        return setting.strip() or None
    return default if several_jobs else None


def union_origins(
    frames: Mapping[str, DataFrame], origin_col: str, auto_id: str | None = None
) -> DataFrame:
    """Rows of several origins, with the same columns, in one frame; equal ids stay apart by their tag."""
    assert_uniform(frames.values())
    tagged = [tag_origin(df, name, origin_col, auto_id) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def conform(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Every target column in target order and type; absent ones take default or NULL."""
    defaults = defaults or {}
    have = {c.lower(): c for c in df.columns}
    columns = []
    for field in schema.fields:
        source = have.get(field.name.lower())
        value = F.col(f"`{source}`") if source else defaults.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
