import datetime as dt
from decimal import Decimal

import pytest

from tidemark.functions import clean


def one(spark, expression, **values):
    """Value of ``expression`` over one row of typed values."""
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(expression.alias("v")).first()["v"]


def text(value):
    return ("string", value)


@pytest.mark.parametrize(
    "value, cut, max_len, expected",
    [
        ("  ab  ", 10, None, "ab"),
        ("    ab", 4, None, None),  # the cut comes first and leaves only blanks
        ("   ab", 4, None, "a"),
        ("abcdef", 6, 3, "abc"),
        ("\tab", 10, None, "\tab"),
        ("   ", 10, None, None),
        ("", 10, None, None),
        (None, 10, None, None),
    ],
)
def test_clean_text(spark, value, cut, max_len, expected):
    assert one(spark, clean.clean_text("a", cut, max_len), a=text(value)) == expected


def test_clean_text_upper_and_numbers(spark):
    assert one(spark, clean.clean_text("a", 50, upper=True), a=text(" baja ")) == "BAJA"
    assert one(spark, clean.clean_text("a", 50), a=("int", 42)) == "42"


@pytest.mark.parametrize(
    "value, expected, usable",
    [
        (" {0a1b2c3d-0000-4111-8222-333344445555} ", "0A1B2C3D-0000-4111-8222-333344445555", True),
        ("0", "0", False),
        ("   ", "", False),
        (None, None, None),
    ],
)
def test_guid(spark, value, expected, usable):
    assert one(spark, clean.normalize_guid("a"), a=text(value)) == expected
    assert one(spark, clean.is_guid(clean.normalize_guid("a")), a=text(value)) == usable


def test_compose_code(spark):
    day = ("timestamp_ntz", dt.datetime(1987, 3, 9, 23, 59))
    code = clean.compose_code("p", "d", "s", 20)
    assert one(spark, code, p=text("abc"), d=day, s=text("1x")) == "ABC8703091X"
    assert one(spark, clean.compose_code("p", "d", "s", 5), p=text("abc"), d=day, s=text("1x")) == "ABC87"
    assert one(spark, code, p=text(None), d=day, s=text("1x")) is None
    assert one(spark, code, p=text("abc"), d=("timestamp_ntz", None), s=text("1x")) is None
    assert one(spark, code, p=text("abc"), d=day, s=text(None)) is None


@pytest.mark.parametrize(
    "parts, expected",
    [
        (("Ana", "Ruiz", "Paz"), "Ana Ruiz Paz"),
        ((None, "Ruiz", None), "Ruiz"),
        (("Ana", None, "Paz"), "Ana Paz"),
        ((None, None, None), None),
    ],
)
def test_full_name(spark, parts, expected):
    values = {k: text(v) for k, v in zip("abc", parts)}
    assert one(spark, clean.full_name("a", "b", "c"), **values) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("123", "00123"), ("12345", "12345"), ("123456", "123456"), ("A12", "A12"),
     ("12345678901234", "1234567890"), ("123\n", "123\n"), (None, None)],
)
def test_pad_digits(spark, value, expected):
    assert one(spark, clean.pad_digits("a"), a=text(value)) == expected


@pytest.mark.parametrize(
    "phones, expected",
    [(("", "0", "55 1234"), "55 1234"), ((" 0 ", None, "7"), "7"), (("0", "", None), None), (("1", "2", "3"), "1")],
)
def test_first_valid(spark, phones, expected):
    values = {k: text(v) for k, v in zip("abc", phones)}
    assert one(spark, clean.first_valid("a", "b", "c"), **values) == expected


def test_dates_do_not_shift_with_the_zone(spark):
    late = dt.datetime(2024, 12, 31, 23, 30)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Mexico_City", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert one(spark, clean.iso_date("d"), d=("timestamp_ntz", late)) == "2024-12-31"
            assert one(spark, clean.short_date("d"), d=("timestamp_ntz", late)) == "241231"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_money(spark):
    assert one(spark, clean.money("a"), a=("decimal(18,4)", Decimal("10.1250"))) == Decimal("10.13")
    assert one(spark, clean.money("a", 4, 2, strict=False), a=("double", 1e6)) is None
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        one(spark, clean.money("a", 4, 2), a=("double", 1e6))


def test_coalesce_ts(spark):
    missing, there = ("timestamp_ntz", None), ("timestamp_ntz", dt.datetime(2020, 5, 1))
    updated = clean.coalesce_ts("a", "b")
    assert one(spark, updated, a=missing, b=there) == dt.datetime(2020, 5, 1)
    assert one(spark, updated, a=missing, b=missing) == dt.datetime(1900, 1, 1)
