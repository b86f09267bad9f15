"""Keys under a collation, in every operator that compares keys, and through a cycle."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.collation import KEY_COLLATIONS, folded
from tidemark.functions.fingerprint import fingerprint, with_fingerprints
from tidemark.model import Destination, SyncJob
from tidemark.operators.changes import classify
from tidemark.operators.conform import lookup
from tidemark.operators.latest import keep_latest
from tidemark.operators.merge import apply_counts, exists_in, match_target, merge_upsert
from tidemark.operators.quality import dup_keys
from tidemark.plans.sync import Workspace, run_cycle
from tidemark.sources.tables import UpsertTable
from tidemark.streaming.loop import newest_rows

LCASE, RTRIM = "UTF8_LCASE", "UTF8_LCASE_RTRIM"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("collation", KEY_COLLATIONS)
def test_folded_texts_are_equal_as_the_collation_says(spark, collation):
    """All letters, in three spellings, with and without blanks, and words with sigmas at their ends."""
    signs = spark.range(32, 0x1F000).where("id not between 55296 and 57343").select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'utf-32')").alias("c"))
    words = spark.createDataFrame([(w,) for w in ("ΣΑΣ", "σας", "σασ", "A ", "a", "A\t", " a", "İx", "i̇X", "ß", "SS", "", " ")], "c string")
    spelled = signs.select(F.explode(F.array("c", F.upper("c"), F.lower("c"), F.concat("c", F.lit(" "))))).toDF("c").union(words).distinct()
    least = lambda group: F.min("c").over(Window.partitionBy(group)).cast("binary")
    both = spelled.select("c", least(F.collate("c", collation)).alias("x"), least(folded(F.col("c"), collation)).alias("y"))
    assert both.where("x <> y").collect() == []


def test_latest_duplicates_and_lookup(spark):
    df = spark.createDataFrame([("A7", 1, 1), ("a7", 1, 3), ("b", 1, 2), ("B ", 1, 5)], "k string, n int, ts int")
    assert rows(keep_latest(df, ["k", "n"], ["ts"], LCASE)) == [("B ", 1, 5), ("a7", 1, 3), ("b", 1, 2)]
    assert rows(keep_latest(df, ["k", "n"], ["ts"], RTRIM)) == [("B ", 1, 5), ("a7", 1, 3)]
    assert keep_latest(df, ["k", "n"], ["ts"]).count() == 4
    assert rows(dup_keys(df, ["k", "n"], LCASE)) == [("A7", 1, 2)]
    assert dup_keys(df, ["k", "n"]).collect() == []
    dim = spark.createDataFrame([("a7", "seven"), ("B", "bee")], "id string, name string")
    found = lookup(df, dim, {"k": "id"}, {"name": "name"}, LCASE)
    assert rows(found.select("k", "name")) == [("A7", "seven"), ("B ", None), ("a7", "seven"), ("b", "bee")]
    assert found.schema["k"].dataType == T.StringType()


def test_merge_keeps_the_spelling_of_the_target(spark):
    target = spark.createDataFrame([("A7", 1, "x", "kept"), ("a7", 1, "y", "kept"), ("c", 1, "z", "kept")], "k string, n int, v string, w string")
    changes = spark.createDataFrame([("a7", 1, "new"), ("C", 2, "other"), ("d", 1, None)], "K string, n int, v string")
    merged = merge_upsert(target, changes, ["K", "N"], {"w": F.lit("made")}, LCASE)
    assert merged.schema == target.schema
    assert rows(merged) == sorted([("A7", 1, "new", "kept"), ("a7", 1, "new", "kept"), ("c", 1, "z", "kept"), ("C", 2, "other", "made"), ("d", 1, None, "made")], key=str)
    changes = changes.withColumnRenamed("K", "k")
    matched = match_target(changes, target, ["k", "n"], LCASE)
    assert rows(matched.select("k", "apply_action")) == [("C", "insert"), ("a7", "update"), ("d", "insert")]
    assert apply_counts(matched).first() == (2, 1)
    assert rows(exists_in(changes, target, ["k", "n"], LCASE)) == [("a7", 1, "new")]


def test_null_keys_numbers_and_the_default_stay(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("A", 2)], "k string, n int")
    assert len(rows(keep_latest(df, ["k"], ["n"], LCASE))) == 2
    one, other = (df.select(fingerprint(df, ["k", "n"], None, c)).collect() for c in (LCASE, "UTF8_BINARY"))
    assert one[1] == one[2] and one[0] == other[0] and other[1] != other[2]


def test_classification_takes_spellings_for_one_key(spark):
    before = with_fingerprints(spark.createDataFrame([("A7", "x"), ("b", "y")], "k string, v string"), ["k"], None, LCASE)
    state = before.selectExpr("'s' stream_id", "'d' destination_id", "key_hash", "data_hash")
    now = with_fingerprints(spark.createDataFrame([("a7", "x"), ("b", "y"), ("c", "z")], "k string, v string"), ["k"], None, LCASE)
    assert rows(classify(now, state, "s", "d").select("k", "change_kind")) == [("a7", "UPDATED"), ("c", "NEW")]


def test_stream_takes_the_newest_spelling(spark):
    df = spark.createDataFrame([("A7", 1, 1), ("a7", 2, 2), ("b", 3, 1)], "k string, v int, at int")
    newest = newest_rows(df, ["k"], "at", LCASE)
    assert newest._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows(newest) == [("a7", 2), ("b", 3)]
    twice = spark.createDataFrame([(None, 1, None), (None, 2, None), ("b", 3, 1), ("B", 4, 1), ("b", 5, None)], "k string, v int, at int")
    assert rows(newest_rows(twice, ["k"], "at", LCASE)) == [("B", 4), ("b", 3), (None, 1), (None, 2)]


def test_cycle(spark, folder):
    work, schema = Workspace(spark, f"{folder}/work"), T.StructType.fromDDL("k string, v string")

    def send(*data, collation=LCASE):
        df = spark.createDataFrame(list(data), schema)
        (m,) = run_cycle(work, [SyncJob("j", lambda _: df, "t", ["k"], key_collation=collation)], [Destination("d", f"{folder}/d")])
        return m["changes"], m["inserted"], m["updated"], m["errors"]

    def stored():
        return rows(UpsertTable(spark, f"{folder}/d/t", schema, ["k"], collation=LCASE).read())

    assert send(("A7", "one"), ("b", "two"), ("Ω", "three")) == (3, 3, 0, 0)
    assert send(("a7", "new"), ("b", "two"), ("ω", "three")) == (2, 0, 2, 0)
    assert stored() == [("A7", "new"), ("b", "two"), ("Ω", "three")]
    assert send(("a7", "new"), ("C", "four")) == (1, 1, 0, 0)
    assert send(("A7", "x"), ("a7", "y")) == (0, 0, 0, 1)  # twice in one extract
    assert len(stored()) == 4
    with pytest.raises(ValueError, match="none of"):
        send(("x", "y"), collation="UNICODE_AI")
