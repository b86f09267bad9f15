"""Ranges of equal depth, mergeable distinct counts, and jobs that are scripts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.model import SyncJob, parameter_names
from tidemark.operators.quality import ConformanceError
from tidemark.operators.reports import distinct_sketches, united_distincts
from tidemark.sources.relational import DepthRange, depth_ranges, literal

SF = "/root/testdata/sf0.001"


def depths(df, column, ranges):
    row = df.agg(*[F.count(F.when(r.column(F.col(column)), 1)).alias(str(k)) for k, r in enumerate(ranges)]).first()
    return list(row)


def once(df, column, ranges):
    hits = sum((r.column(F.col(column)).cast("int") for r in ranges), F.lit(0))
    return df.where(hits != 1).isEmpty()


@pytest.mark.parametrize("parts", [1, 2, 8, 30])
def test_skewed_key_of_line_items(spark, parts):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    # a third of the rows share one key, some have none, the others crowd towards small keys
    skewed = lines.select(F.when(F.col("l_linenumber") % 3 == 0, 77).when(F.col("l_orderkey") % 50 > 0, (F.col("l_orderkey") * F.col("l_orderkey") / 100).cast("long")).alias("k"))
    ranges, n = depth_ranges(skewed, "k", parts), skewed.count()
    assert once(skewed, "k", ranges)
    found = depths(skewed, "k", ranges)
    assert sum(found) == n
    assert max(d for d, r in zip(found, ranges) if not r.single) <= 2 * n / parts + 1
    if parts > 3:
        assert any(r.single and r.low == 77 for r in ranges)
    assert len(ranges) <= 2 * parts


@pytest.mark.parametrize("rows", [[], [(None,)], [(5,)] * 9, [(1,), (2,), (3,)]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "k long")
    ranges = depth_ranges(df, "k", 4)
    assert once(df, "k", ranges) and sum(depths(df, "k", ranges)) == len(rows)


def test_dates_and_predicates(spark):
    df = spark.range(100).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    ranges = depth_ranges(df, "d", 4)
    assert once(df, "d", ranges) and max(depths(df, "d", ranges)) <= 50
    where = " UNION ALL ".join(f"SELECT count(*) n FROM days WHERE {r.predicate('d')}" for r in ranges)
    df.createOrReplaceTempView("days")
    assert sorted(r.n for r in spark.sql(where).collect()) == sorted(depths(df, "d", ranges))
    assert DepthRange().predicate("x") == "1 = 1"
    assert DepthRange(3, 3, False, True).predicate("x") == "x >= 3 AND x <= 3"
    assert DepthRange(None, "o'k").predicate("x") == "(x < 'o''k' OR x IS NULL)"
    assert literal(dt.date(2026, 1, 2)) == "'2026-01-02'"
    for wrong in (None, True, b"x"):
        with pytest.raises(ConformanceError):
            literal(wrong)
    with pytest.raises(ConformanceError):
        depth_ranges(df, "d", 0)


def test_sketches_of_days_are_united(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("p"), (F.col("id") % 10).alias("day"), (F.col("id") % 7_000).alias("v"))
    days = distinct_sketches(df, ["p", "day"], "v")
    assert days.count() == 30
    found = {r.p: r.distinct_values for r in united_distincts(days.unionByName(days.where("day = 1")), ["p"]).collect()}
    assert set(found) == {0, 1, 2} and all(abs(n - 7_000) < 0.06 * 7_000 for n in found.values())
    few = spark.createDataFrame([(1, 5), (1, 5), (1, None), (2, None)], "p int, v int")
    assert sorted(tuple(r) for r in united_distincts(distinct_sketches(few, ["p"], "v"), ["p"]).collect()) == [(1, 1), (2, 0)]
    both = distinct_sketches(few, ["p"], "v", 8).unionByName(distinct_sketches(few, ["p"], "v", 12))
    assert united_distincts(both, ["p"]).count() == 2  # of different sizes


def test_scripts_and_bound_parameters(spark):
    spark.range(10).createOrReplaceTempView("numbers")

    def ids(text, **parameters):
        return [r.id for r in SyncJob("j", text, "t", ["id"], parameters=parameters).frame(spark).collect()]

    assert ids("SELECT id FROM numbers WHERE id > :least;", least=7) == [8, 9]
    script = "BEGIN DECLARE bound INT DEFAULT :least; SET bound = bound + 1; SELECT id FROM numbers WHERE id > bound; END;"
    assert ids(script, least=6) == [8, 9]
    names = spark.createDataFrame([("x' OR '1' = '1",), ("y",)], "id string")
    names.createOrReplaceTempView("names")
    assert ids("SELECT id FROM names WHERE id = :wanted", wanted="x' OR '1' = '1") == ["x' OR '1' = '1"]


def test_scripts_leave_their_rows_with_spark(spark, folder):
    spark.range(10).createOrReplaceTempView("numbers")

    def ids(text, **parameters):
        frame = SyncJob("j", text, "t", ["id"], parameters=parameters).frame(spark, f"{folder}/script")
        assert "LocalTableScan" not in frame._jdf.queryExecution().executedPlan().toString()  # nothing went through the driver
        return sorted(r.id for r in frame.collect())

    assert ids("-- ; select\nBEGIN DECLARE b INT DEFAULT :b; SELECT id FROM numbers WHERE id > b; END;", b=7) == [8, 9]
    branches = "BEGIN SELECT 1 AS id; IF {} THEN SELECT id, '; SELECT 1' AS t FROM numbers WHERE id < 2; ELSE SELECT 9 AS id; END IF; END"
    assert ids(branches.format("2 > 1")) == [0, 1] and ids(branches.format("1 > 2")) == [9]
    loop = "BEGIN DECLARE i INT DEFAULT 0; WHILE i < 3 DO SET i = i + 1; WITH w AS (SELECT id FROM numbers) SELECT * FROM w WHERE id = i; END WHILE; END"
    assert ids(loop) == [3]
    assert ids("BEGIN (SELECT CASE WHEN id > 3 THEN id ELSE (SELECT max(id) FROM numbers) END AS id FROM numbers WHERE id IN (2, 4)); END") == [4, 9]
    assert ids("BEGIN SELECT id FROM numbers WHERE id > 99; END") == []
    assert SyncJob("j", "BEGIN DECLARE x INT; SET x = 1; END", "t", ["id"]).frame(spark, f"{folder}/script").columns == []


def test_unknown_parameters_are_errors_before_anything_is_read():
    for text, given in (("SELECT :a", {}), ("SELECT 1", {"a": 1}), ("BEGIN SELECT 1; SELECT :b; END", {"a": 1})):
        with pytest.raises(ConformanceError, match="has parameters"):
            SyncJob("j", text, "t", ["id"], parameters=given)
    assert parameter_names("SELECT ':no', \":no\", `:no`, x::int, v:no -- :no\n, :yes /* :no\n */ FROM t WHERE a=:also") == {"yes", "also"}
