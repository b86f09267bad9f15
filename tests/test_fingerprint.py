import datetime as dt
from decimal import Decimal

import pytest

from tidemark.functions.fingerprint import fingerprint, stream_id, with_fingerprints


def prints(spark, rows, schema, **options):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(fingerprint(df, **options)).collect()]


def test_values_that_must_differ(spark):
    rows = [
        (None, "x", "y"), ("", "x", "y"), ("x", None, "y"), ("x", "y", None), ("xy", "", ""), ("x", "y", ""),
        ("~", "x", "y"), ("1:x", "", "y"), ("", "1:x", "y"),
    ]
    found = prints(spark, rows, "a string, b string, c string")
    assert len(set(found)) == len(rows)
    assert all(len(f) == 64 for f in found)


def test_kinds_differ(spark):
    one = {
        "int": 1, "string": "1", "boolean": True, "double": 1.0, "decimal(5,2)": Decimal("1.00"),
        "date": dt.date(1970, 1, 2), "timestamp_ntz": dt.datetime(1970, 1, 2),
        "timestamp": dt.datetime(1970, 1, 2), "binary": bytearray(b"1"), "array<string>": ["1"],
        "map<string,string>": {"1": "1"}, "struct<x:string>": ("1",),
    }
    found = {t: prints(spark, [(v,)], f"a {t}")[0] for t, v in one.items()}
    assert len(set(found.values())) == len(one)
    # widening an integer column is not a change
    assert prints(spark, [(1,)], "a bigint")[0] == found["int"]


def test_microseconds_and_special_floats(spark):
    times = [(dt.datetime(2024, 1, 1, 0, 0, 0, micro),) for micro in (0, 1, 1000)]
    for kind in ("timestamp", "timestamp_ntz"):
        assert len(set(prints(spark, times, f"a {kind}"))) == 3
    floats = [(0.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    assert len(set(prints(spark, floats, "a double"))) == 5
    assert prints(spark, [(0.0,)], "a double") == prints(spark, [(-0.0,)], "a double")


def test_column_order_is_irrelevant_and_a_new_column_is_not(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    swapped = df.select("b", "a")
    wider = df.selectExpr("a", "b", "cast(null as string) c")
    renamed = df.selectExpr("a", "b as d")
    one, two, three, four = [d.select(fingerprint(d)).first()[0] for d in (df, swapped, wider, renamed)]
    assert one == two
    assert len({one, three, four}) == 3


def test_nested_values(spark):
    schema = "a map<string,int>, b array<string>, c struct<x:int,y:string>"
    rows = [
        ({"p": 1, "q": 2}, ["u", "v"], (1, "z")),
        ({"q": 2, "p": 1}, ["u", "v"], (1, "z")),
        ({"p": 1, "q": 2}, ["v", "u"], (1, "z")),
        ({"p": 1, "q": None}, ["u", "v"], (1, "z")),
        ({"p": 1, "q": 2}, ["u", None, "v"], (1, "z")),
        ({"p": 1, "q": 2}, ["uv"], (1, "z")),
        ({"p": 1, "q": 2}, ["u", "v"], (None, "z")),
        (None, [], (1, "z")),
        ({}, None, (1, "z")),
    ]
    found = prints(spark, rows, schema)
    assert found[0] == found[1]
    assert len(set(found)) == len(rows) - 1


def test_declared_decimals(spark):
    assert prints(spark, [(0.1 + 0.2,)], "a double", decimals={"a": (12, 2)}) == prints(
        spark, [(0.3,)], "a double", decimals={"a": (12, 2)}
    )
    assert prints(spark, [(0.1 + 0.2,)], "a double") != prints(spark, [(0.3,)], "a double")


def test_unsupported_kind(spark):
    df = spark.sql("select interval '1' day as a")
    with pytest.raises(TypeError):
        fingerprint(df)


def test_stream_id():
    a = stream_id("companies", "erp_company", ["id"])
    assert len(a) == 32
    assert a != stream_id("companies", "other", ["id"])
    assert stream_id("j", "t", ["a", "b"]) != stream_id("j", "t", ["b", "a"])
    assert stream_id("j", "t", ["a,b"]) != stream_id("j", "t", ["a", "b"])


def test_no_python_in_the_plan(spark):
    df = with_fingerprints(spark.createDataFrame([(1, "x")], "a int, b string"), ["a"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
