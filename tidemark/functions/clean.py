"""Column expressions that clean and compose source values.

Everything here is a composition of built-in functions, so it stays inside
whole-stage codegen and the columns it reads are still pruned at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "0123456789"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Column | str, cut: int, max_len: int | None = None, upper: bool = False) -> Column:
    """Cut to ``cut`` characters, trim blanks, turn '' into NULL, cut to ``max_len``.

    The first cut comes *before* the trim, so leading blanks use up length.
    Only the blank character is trimmed; tabs and line ends are kept.
    """
    text = F.trim(F.substring(_column(value).cast("string"), 1, cut))
    text = F.nullif(text, F.lit(""))
    if max_len is not None and max_len < cut:
        text = F.left(text, F.lit(max_len))
    return F.upper(text) if upper else text


def normalize_guid(value: Column | str, cut: int = 40) -> Column:
    """Upper-case identifier text without surrounding blanks or braces."""
    text = F.trim(F.substring(_column(value).cast("string"), 1, cut))
    return F.upper(F.translate(text, "{}", ""))


def is_guid(value: Column | str, length: int = 36) -> Column:
    """True for text of exactly ``length`` characters, trailing blanks not counted."""
    return F.length(F.rtrim(_column(value))) == length


def iso_date(value: Column | str) -> Column:
    """Calendar date as ``yyyy-MM-dd`` text. Text never shifts with a time zone."""
    return _column(value).cast("date").cast("string")


def short_date(value: Column | str) -> Column:
    """Calendar date as ``yyMMdd`` text."""
    return F.date_format(_column(value).cast("date"), "yyMMdd")


def compose_code(prefix: Column | str, date: Column | str, suffix: Column | str, max_len: int) -> Column:
    """prefix + yyMMdd + suffix, upper-cased and cut; NULL when any part is NULL."""
    code = F.concat(_column(prefix), short_date(date), _column(suffix))
    return F.left(F.upper(code), F.lit(max_len))


def full_name(*parts: Column | str, max_len: int = 200) -> Column:
    """Present parts joined by one blank; NULL when every part is missing."""
    joined = F.trim(F.concat_ws(" ", *[_column(p) for p in parts]))
    return F.left(F.nullif(joined, F.lit("")), F.lit(max_len))


def pad_digits(value: Column | str, width: int = 5, max_len: int = 10) -> Column:
    """Left-pad short all-digit text with zeros; other text is only cut.

    The digit test removes digits and looks for a remainder, which unlike a
    ``$``-anchored pattern does not overlook a trailing line end.
    """
    text = _column(value)
    only_digits = F.translate(text, DIGITS, "") == ""
    return F.when(
        only_digits & (F.length(F.rtrim(text)) <= width), F.lpad(text, width, "0")
    ).otherwise(F.left(text, F.lit(max_len)))


def first_valid(
    *values: Column | str, reject: Sequence[str] = ("0",), cut: int = 30, max_len: int = 30
) -> Column:
    """First value that is neither blank nor one of ``reject``."""
    candidates = []
    for value in values:
        text = clean_text(value, cut)
        for unwanted in reject:
            text = F.nullif(text, F.lit(unwanted))
        candidates.append(text)
    return F.left(F.coalesce(*candidates), F.lit(max_len))


def money(value: Column | str, precision: int = 12, scale: int = 2, strict: bool = True) -> Column:
    """Fixed-point amount. ``strict`` raises on overflow, otherwise it gives NULL."""
    target = f"decimal({precision},{scale})"
    return _column(value).cast(target) if strict else _column(value).try_cast(target)


def coalesce_ts(*values: Column | str, default: str = "1900-01-01 00:00:00") -> Column:
    """First timestamp present, else ``default``."""
    fallback = F.lit(default).cast("timestamp_ntz")
    return F.coalesce(*[_column(v) for v in values], fallback)
