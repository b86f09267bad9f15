"""Row and key fingerprints.

A fingerprint is the SHA-256 of a text that names every column and says, for
each value, its kind, its length and its text. Lengths keep neighbouring
values apart, ``~`` keeps NULL apart from '' and the kind keeps 1 apart from
'1'. Columns are taken in name order, so their order in a table is irrelevant.

Hashes are built by codegen'd built-ins: no Python runs per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.collation import BINARY, folded, is_text


def _body(value: Column, kind: T.DataType) -> tuple[str, Column]:
    """Kind letter and text of a non-NULL value."""
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "s", value.cast("string")
    if isinstance(kind, T.BooleanType):
        return "b", value.cast("string")
    if isinstance(kind, T.IntegralType):
        return "i", value.cast("string")
    if isinstance(kind, T.DecimalType):
        return "n", value.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # adding zero turns -0.0 into 0.0; NaN and the infinities keep their names
        return "f", (value.cast("double") + F.lit(0.0)).cast("string")
    if isinstance(kind, T.DateType):
        return "d", value.cast("string")
    if isinstance(kind, T.TimestampNTZType):
        return "t", value.cast("string")
    if isinstance(kind, T.TimestampType):
        return "u", F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return "x", F.base64(value)
    if isinstance(kind, T.ArrayType):
        return "a", F.array_join(F.transform(value, lambda e: _segment(e, kind.elementType)), "")
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return "o", F.concat(*[_named(f.name, value.getField(f.name), f.dataType) for f in fields])
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.concat(
                _segment(e.getField("key"), kind.keyType), _segment(e.getField("value"), kind.valueType)
            ),
        )
        return "m", F.array_join(F.array_sort(entries), "")
    raise TypeError(f"cannot fingerprint a value of type {kind.simpleString()}")


def _segment(value: Column, kind: T.DataType, name: str = "") -> Column:
    tag, text = _body(value, kind)
    return F.coalesce(
        F.concat(F.lit(f"{name}{tag}"), F.length(text).cast("string"), F.lit(":"), text),
        F.lit(f"{name}~"),
    )


def _named(name: str, value: Column, kind: T.DataType) -> Column:
    return _segment(value, kind, f"{len(name)}:{name}=")


def fingerprint(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    decimals: Mapping[str, tuple[int, int]] | None = None,
    collation: str = BINARY,
    inside: str | None = None,
) -> Column:
    """64 hex characters over ``columns`` (default: every column of ``df``), never NULL.

    ``inside`` names a struct column that holds the columns of ``df`` as its fields, in a frame made from it.

    ``decimals`` declares (precision, scale) for floating-point columns. Declared
    columns are hashed as fixed-point text, which any engine reproduces and no
    change of float formatting can disturb. Texts that are equal under
    ``collation`` give the same fingerprint.
    """
    declared = decimals or {}
    segments = []
    for name in sorted(columns if columns is not None else df.columns):
        value, kind = F.col(f"{inside}.`{name}`" if inside else f"`{name}`"), df.schema[name].dataType
        if name in declared:
            kind = T.DecimalType(*declared[name])
            value = value.cast(kind)
        elif is_text(df, name):
            value = folded(value, collation)
        segments.append(_named(name, value, kind))
    # SHA-256 of a text is a text; said to Spark, joins on it need no filter, and a shuffle that two of them need is made once
    return F.coalesce(F.sha2(F.concat(*segments), 256), F.lit(""))


def packed(hashes: Column, nullable: bool = True) -> Column:
    """Hex fingerprints as their 32 bytes, any other text as its bytes and 33 more: :func:`unpacked` gives each text back.

    What is shuffled, sorted and compared is then half as long.
    """
    value = F.when(hashes.rlike(r"\A[0-9a-f]{64}\z"), F.unhex(hashes)).otherwise(F.concat(hashes.cast("binary"), F.lit(bytes(33))))
    return value if nullable else F.coalesce(value, F.lit(b""))


def unpacked(value: Column) -> Column:
    """The text that :func:`packed` made ``value`` of."""
    text = F.substring(value, F.lit(1), F.octet_length(value) - 33).cast("string")
    return F.when(F.octet_length(value) == 32, F.lower(F.hex(value))).otherwise(text)


def with_fingerprints(
    df: DataFrame, keys: Sequence[str], decimals: Mapping[str, tuple[int, int]] | None = None, collation: str = BINARY
) -> DataFrame:
    """Add ``key_hash`` over ``keys``, under ``collation``, and ``data_hash`` over every column as it is."""
    return df.withColumns(
        {
            "key_hash": fingerprint(df, keys, decimals, collation),
            "data_hash": fingerprint(df, None, decimals),
        }
    )


def _packed(*parts: str) -> str:
    return "".join(f"{len(p)}:{p}" for p in parts)


def stream_id(job: str, table: str, keys: Sequence[str]) -> str:
    """32 hex characters naming one (job, target table, *ordered* keys) stream."""
    text = _packed(job, table, _packed(*keys))
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:32]


def batch_id(stream: str, destination: str, version: int, lineage: str = "") -> str:
    """Name of the delivery that starts from state ``version``; a retry reuses it.

    ``lineage`` tells states apart that count from zero again.
    """
    text = _packed(stream, destination, str(version), lineage)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:32]
