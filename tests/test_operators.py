import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fingerprint import packed, stream_id, unpacked, with_fingerprints
from tidemark.operators import changes, conform, merge, quality, reports
from tidemark.operators.audit import audit_flags, cycle_totals, retain
from tidemark.operators.latest import keep_latest, newest_first


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


# --- newest row per key -------------------------------------------------------


def test_keep_latest_orders_and_ties(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    df = spark.createDataFrame(
        [("a", 1, t(1)), ("a", 2, t(3)), ("a", 3, None), ("b", 4, t(2)), ("b", 5, t(2)), ("c", 6, None)],
        "k string, id int, ts timestamp_ntz",
    )
    kept = keep_latest(df, ["k"], newest_first("ts", "id"))
    assert rows(kept, "k", "id") == [("a", 2), ("b", 5), ("c", 6)]
    assert rows(keep_latest(df, ["k"], ["ts", "id"]), "k", "id") == [("a", 2), ("b", 5), ("c", 6)]


def test_required_value_is_checked_after_the_choice(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, None), ("b", 1, "x")], "k string, v int, name string")
    left = conform.require(keep_latest(df, ["k"], ["v"]), F.col("name").isNotNull())
    assert rows(left, "k") == [("b",)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 20000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    kept = keep_latest(df, ["k"], ["v"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan.split("Exchange")[1]
    hot = kept.where("k = 0").collect()
    assert len(hot) == 1 and hot[0]["v"] == 19998
    assert kept.count() == df.select("k").distinct().count()


# --- lookups, guards and origins ---------------------------------------------


def test_lookup_keeps_unmatched_and_multiplies_repeats(spark):
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 12)], "id int, fk int")
    dim = spark.createDataFrame([(10, "x"), (12, "p"), (12, "q")], "key int, name string")
    assert rows(conform.lookup(fact, dim, {"fk": "key"}, {"name": "n"}), "id", "n") == [
        (1, "x"), (2, None), (3, None), (4, "p"), (4, "q"),
    ]
    assert rows(quality.dup_keys(dim, ["key"])) == [(12, 2)]


def test_guard_source(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    identity = spark.createDataFrame([("G-1",), ("G-1",)], "guid string")
    assert conform.guard_source(df, identity, "guid", "G-1").count() == 2
    assert conform.guard_source(df, identity, "guid", "G-2").count() == 0


def test_lists_and_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert rows(conform.among(df, "v", [1])) == [(1,)]
    assert rows(conform.among(df, "v", [1], negate=True)) == [(2,)]


def test_origins(spark):
    df = spark.createDataFrame([(7, "A")], "source_id int, value string")
    both = conform.union_origins({"North": df, "South": df}, "origin", auto_id="id")
    assert rows(both) == [(7, "A", "North"), (7, "A", "South")]
    assert conform.tag_origin(df, "North", None).columns == df.columns
    with pytest.raises(quality.ConformanceError):
        conform.tag_origin(df, "North", "VALUE")
    with pytest.raises(quality.ConformanceError):
        conform.tag_origin(df, "North", None, auto_id="Source_Id")
    with pytest.raises(quality.ConformanceError):
        quality.assert_origin_column("ID", "id")


def test_origin_column():
    assert conform.origin_column(False, "source_name", True) is None
    assert conform.origin_column(True, "source_name", True) == "source_name"
    assert conform.origin_column(True, None, True) == "row_origin"
    assert conform.origin_column(True, None, False) is None
    assert conform.origin_column(True, "  ", True) is None


def test_conform_fills_and_orders(spark):
    schema = T.StructType.fromDDL("id bigint, made timestamp_ntz, name string, note string")
    df = spark.createDataFrame([("x", 1)], "NAME string, ID int")
    out = conform.conform(df, schema, {"note": F.lit("n")})
    assert out.schema.names == schema.names and out.schema["id"].dataType == T.LongType()
    assert rows(out) == [(1, None, "x", "n")]


# --- checks ------------------------------------------------------------------


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a")], "Id int, name string")
    assert quality.canonical_keys(df, ["ID", "Name"]) == ["Id", "name"]
    for bad in (["nope"], []):
        with pytest.raises(quality.ConformanceError):
            quality.canonical_keys(df, bad)
    quality.assert_uniform([df, df.select("name", "Id")])
    with pytest.raises(quality.ConformanceError):
        quality.assert_uniform([df, df.select("name")])
    quality.assert_subset(df, ["id", "NAME", "more"], ["created"])
    with pytest.raises(quality.ConformanceError, match="do not exist"):
        quality.assert_subset(df, ["id"])
    with pytest.raises(quality.ConformanceError, match="must not be written"):
        quality.assert_subset(df, ["id", "name"], ["ID"])


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (None, None)], "a int, b int")
    assert rows(quality.null_keys(df, ["a", "b"])) == [(1, None), (None, None)]
    assert rows(quality.dup_keys(df, ["a", "b"])) == [(1, 1, 2)]
    with pytest.raises(quality.ConformanceError, match="repeated"):
        quality.assert_no_rows(quality.dup_keys(df, ["a", "b"]), "repeated")


# --- reports -----------------------------------------------------------------


def test_reports(spark):
    child = spark.createDataFrame(
        [("c1", "001"), ("c1", "001"), ("c1", "002"), ("c2", "001"), ("c9", "003"), (None, "004"), ("c2", None)],
        "company string, number string",
    )
    parent = spark.createDataFrame([("c1", "One"), ("c2", "Two"), ("c3", "Three")], "id string, name string")
    assert rows(reports.count_by_parent(child, parent, "company", "id", "name")) == sorted(
        [("c1", "One", 3), ("c2", "Two", 2), ("c9", None, 1), (None, None, 1)], key=str
    )
    assert rows(reports.unexpected_parents(child, "company", ["c1"])) == [("c2", 2), ("c9", 1)]
    assert rows(reports.orphan_counts(child, parent, "company", "id")) == sorted([("c9", 1), (None, 1)], key=str)
    assert rows(conform.orphans(child, parent, "company", "id")) == sorted([("c9", "003"), (None, "004")], key=str)
    assert rows(reports.duplicate_keys(child, ["company", "number"])) == [("c1", "001", 2)]
    assert rows(reports.shared_values(child, "number", "company")) == [("001", 2)]


def test_count_by_parent_with_a_repeated_parent(spark):
    child = spark.createDataFrame([(1,), (1,)], "fk int")
    parent = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "id int, name string")
    assert rows(reports.count_by_parent(child, parent, "fk", "id", "name")) == [(1, "a", 4), (1, "b", 2)]


# --- change detection --------------------------------------------------------


SHIFTS = "plant string, badge int, hours decimal(6,2), note string"
SHIFT_KEYS = ["plant", "badge"]


def fingerprinted(spark, data, keys=SHIFT_KEYS):
    return with_fingerprints(spark.createDataFrame([(p, b, Decimal(h), n) for p, b, h, n in data], SHIFTS), list(keys))


def as_state(df, stream, destination):
    return df.select(F.lit(stream).alias("stream_id"), F.lit(destination).alias("destination_id"), "key_hash", "data_hash")


def delivered(found, stream, destination):
    return found.withColumns({"stream_id": F.lit(stream), "destination_id": F.lit(destination)})


NORTH, SOUTH, NO_PLANT = ("north", 17, "7.50", None), ("south", 17, "8.00", "late"), (None, 4, "0.25", "")


def test_classify_against_what_each_destination_got(spark):
    """A key of two columns and a null in it; null and empty, and equal values under other keys, are told apart."""
    stream = stream_id("shifts", "hours_worked", SHIFT_KEYS)
    before = fingerprinted(spark, [NORTH, SOUTH, NO_PLANT])
    archive = as_state(before, stream, "archive")
    now = fingerprinted(spark, [("north", 17, "7.50", ""), SOUTH, NO_PLANT, ("south", 4, "0.25", "")])
    expected = [("north", 17, "UPDATED"), ("south", 4, "NEW")]
    assert rows(changes.classify(now, archive, stream, "archive"), "plant", "badge", "change_kind") == expected
    # a destination without a state, and one whose state belongs to another stream, know nothing
    elsewhere = as_state(before, stream_id("shifts", "other_table", SHIFT_KEYS), "ledger")
    for state, name in ((archive, "ledger"), (elsewhere, "ledger")):
        assert rows(changes.classify(now, state, stream, name), "change_kind") == [("NEW",)] * 4
    both = changes.classify_all(now, archive.unionByName(elsewhere), {"archive": stream, "ledger": stream})
    assert rows(changes.change_counts(both)) == [("archive", "NEW", 1), ("archive", "UPDATED", 1), ("ledger", "NEW", 4)]


def test_values_that_go_back_and_forth_are_sent_each_time(spark):
    stream = stream_id("shifts", "hours_worked", SHIFT_KEYS)
    state = as_state(fingerprinted(spark, []), stream, "d")
    kinds = []
    for hours in ("1.00", "2.00", "1.00", "1.00"):
        found = changes.classify(fingerprinted(spark, [("north", 1, hours, None)]), state, stream, "d")
        kinds.append([r.change_kind for r in found.collect()])
        state = changes.commit(state, delivered(found, stream, "d"))
    assert kinds == [["NEW"], ["UPDATED"], ["UPDATED"], []]


def test_classify_all_takes_the_last_of_several_hashes(spark):
    stream = stream_id("shifts", "hours_worked", SHIFT_KEYS)
    old, new = fingerprinted(spark, [NORTH]), fingerprinted(spark, [("north", 17, "9.00", None)])
    state = (
        as_state(old, stream, "d").withColumn("seq", F.lit(1))
        .unionByName(as_state(new, stream, "d").withColumn("seq", F.lit(2)))
    )
    assert changes.classify_all(new, state, {"d": stream}).count() == 0
    assert rows(changes.classify_all(old, state, {"d": stream}), "change_kind") == [("UPDATED",)]


def test_vanished_keys_stay_known(spark):
    stream = stream_id("shifts", "hours_worked", SHIFT_KEYS)
    state = as_state(fingerprinted(spark, [NORTH, SOUTH]), stream, "d")
    found = changes.classify(fingerprinted(spark, [("south", 17, "1.00", None)]), state, stream, "d")
    after = changes.commit(state, delivered(found, stream, "d"))
    assert after.count() == 2
    assert changes.classify(fingerprinted(spark, [NORTH, ("south", 17, "1.00", None)]), after, stream, "d").count() == 0


def test_migrate(spark):
    data = fingerprinted(spark, [NORTH, SOUTH])
    old, new = stream_id("shifts", "hours", SHIFT_KEYS), stream_id("shifts", "hours_worked", SHIFT_KEYS)
    state = as_state(data, old, "archive").unionByName(as_state(data, old, "ledger"))
    state = state.unionByName(as_state(data.limit(1), new, "ledger"))
    moved = changes.migrate(state, old, new)
    assert rows(changes.state_summary(moved)) == sorted([(new, "archive", 2), (new, "ledger", 1)])
    assert changes.classify(data, moved, new, "archive").count() == 0
    assert rows(changes.migrate(moved, old, new)) == rows(moved)
    assert changes.migrate(state, old, old) is state


# --- merge -------------------------------------------------------------------


def test_merge_upsert(spark):
    target = spark.createDataFrame(
        [(1, "a", "x", "t1"), (2, "b", "y", "t2"), (2, "b2", "y2", "t3"), (3, "c", "z", "t4")],
        "id int, name string, kept string, made string",
    )
    new = spark.createDataFrame([(2, "B"), (3, None), (9, "N")], "id int, name string")
    merged = merge.merge_upsert(target, new, ["id"], {"made": F.lit("now")})
    assert merged.columns == target.columns
    assert rows(merged) == [
        (1, "a", "x", "t1"), (2, "B", "y", "t2"), (2, "B", "y2", "t3"), (3, None, "z", "t4"), (9, "N", None, "now"),
    ]
    matched = merge.match_target(new, target, ["id"])
    assert rows(matched, "id", "apply_action") == [(2, "update"), (3, "update"), (9, "insert")]
    assert rows(merge.apply_counts(matched)) == [(1, 2)]
    assert rows(merge.exists_in(new, target, ["id"]), "id") == [(2,), (3,)]


def test_merge_with_key_columns_only(spark):
    target = spark.createDataFrame([(1, 1)], "a int, b int")
    new = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert rows(merge.merge_upsert(target, new, ["a", "b"])) == [(1, 1), (1, 2)]


def test_merge_plans_have_no_cross_or_full_outer_join(spark):
    target = spark.range(1000).selectExpr("id", "id as v")
    new = spark.range(900, 1100).selectExpr("id", "-id as v")
    plan = merge.merge_upsert(target, new, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "FullOuter" not in plan and "NestedLoop" not in plan


def test_hot_target_key_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        target = spark.range(0, 60000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("name"),
        )
        new = spark.range(0, 500).select("id", F.lit("new").alias("name"))
        merged = merge.merge_upsert(target, new, ["id"])
        assert merged.where("name = 'new'").count() == 20000 + 499 - 166 + 166
        # collecting runs the plan of this frame itself, which then shows what was split
        assert len(merged.collect()) == merged.count()
        assert "skew=true" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_backfill(spark):
    target = spark.createDataFrame([(1, "E", None), (2, "E", "old"), (3, "E", "g"), (4, "X", None)], "id int, src string, fk string")
    parents = spark.createDataFrame([("g",), ("g",)], "pk string")
    chosen = F.col("src") == "E"
    assert rows(merge.backfill(target, parents, "fk", "pk", "g", chosen), "id", "fk") == [
        (1, "g"), (2, "g"), (3, "g"), (4, None),
    ]
    assert rows(merge.backfill(target, parents, "fk", "pk", "none", chosen)) == rows(target)


# --- audit -------------------------------------------------------------------


def test_audit_flags_hold_no_values(spark):
    changed = fingerprinted(spark, [("north", 1, "1.00", "secret")]).withColumns(
        {"stream_id": F.lit("s"), "destination_id": F.lit("d"), "change_kind": F.lit("NEW")}
    )
    flag = audit_flags(changed, "job", F.lit(dt.datetime(2024, 5, 6, 7)).cast("timestamp_ntz")).first()
    assert flag["event_date"] == dt.date(2024, 5, 6) and flag["event"] == "NEW"
    assert len(flag["row_fingerprint"]) == len(flag["data_fingerprint"]) == 24
    assert "secret" not in str(flag)


def test_retain_and_totals(spark):
    flags = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 31)], "event_date date")
    assert retain(flags, F.lit(dt.date(2024, 2, 1)), 30).count() == 2
    metrics = spark.createDataFrame(
        [("c", "j1", "d1", 10, 3, 0), ("c", "j1", "d2", 10, 0, 1), ("c", "j2", None, 0, 0, 1)],
        "cycle_id string, job string, destination string, rows_read long, changes long, errors long",
    )
    assert rows(cycle_totals(metrics)) == [("c", 10, 3, 2, 1)]


def _exchanges(df):
    """Exchanges by key hash in the final plan, without those that are used again, and the types they shuffle the hashes as."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len([line for line in plan.splitlines() if "Exchange hashpartitioning(key_hash" in line and "Reused" not in line])


def test_packed_hashes_are_texts_again(spark):
    texts = ["ab" * 32, "AB" * 32, "ab" * 32 + "\n", "ab" * 31, "", "\0" * 33, "é" * 16, "k", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", packed(F.col("t")).alias("p")).select("t", "p", unpacked(F.col("p")).alias("u")).collect()
    assert [r.u for r in found] == texts and len({bytes(r.p) for r in found if r.p is not None}) == len(texts) - 1
    assert [len(r.p) for r in found[:2]] == [32, 97]


def test_commit_classifies_once_and_shuffles_bytes(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held, now = [with_fingerprints(spark.range(n, n + 100).withColumn("v", F.col("id") % m), ["id"]) for n, m in ((0, 7), (50, 5))]
        state = held.select(F.lit("s").alias("stream_id"), F.lit("d").alias("destination_id"), "key_hash", "data_hash")
        found = changes.classify(now, state, "s", "d").withColumns({"stream_id": F.lit("s"), "destination_id": F.lit("d")})
        committed = changes.commit(state, found)
        assert committed.count() == 150 and committed.schema["key_hash"].dataType.simpleString() == "string"
        assert _exchanges(committed) == 3  # state, snapshot and changed keys, each once
        plan = changes.classify(now, state, "s", "d")._jdf.queryExecution().analyzed().toString()
        assert "unhex(key_hash" in plan and "isnotnull(sha2" not in committed._jdf.queryExecution().optimizedPlan().toString()
        wanted = {(r.key_hash, r.data_hash) for r in now.collect()} | {(r.key_hash, r.data_hash) for r in held.where("id < 50").collect()}
        assert {(r.key_hash, r.data_hash) for r in committed.collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_commit_keeps_repeated_and_missing_keys(spark):
    ddl = "stream_id string, destination_id string, key_hash string, data_hash string"
    state = spark.createDataFrame([("s", "d", "k", "1"), ("s", "d", "k", "2"), ("s", "d", None, "3"), ("s", "e", "k", None), ("s", "d", "m", "4"), ("s", "d", "m", "4")], ddl)
    new = spark.createDataFrame([("s", "d", "k", "5"), ("s", "d", None, "6")], ddl)
    found = sorted(map(str, ((r.destination_id, r.key_hash, r.data_hash) for r in changes.commit(state, new).collect())))
    assert found == sorted(map(str, [("d", "k", "5"), ("d", None, "3"), ("d", None, "6"), ("e", "k", None), ("d", "m", "4"), ("d", "m", "4")]))
