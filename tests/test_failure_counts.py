"""Failures counted in streaming state against the batch operator."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.failures import failure_burst
from tidemark.sources.failure_log import FAILURES, FailureLog
from tidemark.streaming.failure_counts import FailureCounts, second_counts

SCOPE = T.StructType([T.StructField("scope", T.StringType())])
START = dt.datetime(2026, 1, 1)


def arrive(spark, folder, *failures):
    """One file of (scope, seconds after the start)."""
    rows = [(scope, START + dt.timedelta(seconds=s)) for scope, s in failures]
    spark.createDataFrame(rows, "scope string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")


def watch(spark, folder, **options):
    counted = FailureCounts(spark, f"{folder}/counts", SCOPE, **{"hours": 1, "threshold": 3, **options})
    stream = spark.readStream.schema("scope string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = counted.watch(stream, poll=None)
    query.awaitTermination(120)
    return counted, query


def found(counted):
    rows = counted.bursts().collect()
    return sorted(((r.scope, (r.second - START).total_seconds(), r.failures, r.in_window, r.tripped) for r in rows), key=str)


def batch(spark, folder):
    seconds = spark.read.parquet(f"{folder}/in").withColumn("second", F.date_trunc("second", "ts"))
    rows = failure_burst(seconds, ["scope"], "second", 1, 3).collect()
    return sorted(((r.scope, (r.second - START).total_seconds(), r.failures, r.in_window, r.tripped) for r in rows), key=str)


def test_equal_to_the_batch_window(spark, folder):
    arrive(spark, folder, ("a", 0), ("a", 0.25), ("b", 5))
    arrive(spark, folder, ("a", 0.5), ("a", 3600), ("b", 1800.75), (None, 10))
    arrive(spark, folder, ("a", 3601), ("a", 2.5), ("b", 1800.25), (None, 11))
    counted, _ = watch(spark, folder)
    assert found(counted) == batch(spark, folder)


def test_failures_that_come_too_late_do_not_count(spark, folder):
    arrive(spark, folder, ("a", 10_000), ("a", 10_001))
    arrive(spark, folder, ("a", 10_002))
    arrive(spark, folder, ("a", 10_002 - 3_590), ("a", 10_002 - 3_700))  # within the watermark, and beyond it
    counted, _ = watch(spark, folder)
    assert sorted(r[1] for r in found(counted)) == [10_002 - 3_590, 10_000, 10_001, 10_002]


def test_state_is_bounded_by_the_window(spark, folder):
    for hour in range(12):
        arrive(spark, folder, *[("a", hour * 3600 + 60 * k) for k in range(60)])
    counted, query = watch(spark, folder)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert counted.counts().count() == 12 * 60
    assert max(kept) <= 3 * 60 + 2  # the window, the batch that moved the watermark, and the one before


def test_an_epoch_that_is_replayed_counts_once(spark, folder):
    arrive(spark, folder, ("a", 1), ("a", 2))
    watch(spark, folder)
    arrive(spark, folder, ("a", 2), ("a", 3))
    before, _ = watch(spark, folder)
    expected = found(before)
    commits = sorted((int(os.path.basename(p)), p) for p in glob.glob(f"{folder}/counts/checkpoint/commits/*") if os.path.basename(p).isdigit())
    for at, path in commits[1:]:  # as if the driver had died before it noted them
        os.remove(path)
        crc = f"{folder}/counts/checkpoint/commits/.{at}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    after, _ = watch(spark, folder)
    assert found(after) == expected == [("a", 1.0, 1, 1, False), ("a", 2.0, 2, 3, True), ("a", 3.0, 1, 4, True)]


def test_folded_epochs_say_the_same(spark, folder):
    for k in range(5):
        arrive(spark, folder, ("a", k), ("b", 0))
    counted, _ = watch(spark, folder, fold_every=2)
    assert found(counted) == batch(spark, folder)
    assert len(os.listdir(f"{folder}/counts/folded")) == 1
    assert len([f for f in os.listdir(f"{folder}/counts/counts") if f.startswith("epoch=")]) <= 2


def test_counts_on_a_table(spark):
    df = spark.createDataFrame([("a", START), ("a", START + dt.timedelta(milliseconds=999)), ("a", START + dt.timedelta(seconds=1))], "scope string, ts timestamp")
    rows = second_counts(df, ["scope"], "ts", 1).collect()
    assert sorted((r.scope, (r.second - START).total_seconds(), r.failures) for r in rows) == [("a", 0.0, 2), ("a", 1.0, 1)]
    assert second_counts(df.limit(0), ["scope"], "ts", 1).collect() == []


def test_states_tell_the_last_failure_and_the_latch(spark, folder):
    log = FailureLog(spark, f"{folder}/log", hours=1, threshold=2)
    assert log.states().collect() == []
    at = lambda m: START + dt.timedelta(minutes=m)
    log.absorb(spark.createDataFrame([("a", at(1), "s", None, "one"), ("a", at(3), "s", None, "two"), ("b", at(2), "s", None, "three")], FAILURES))
    log.clear("b", at(5))
    rows = {r.scope: r for r in log.states().collect()}
    assert set(rows) == {"a"} and (rows["a"].failures, rows["a"].first_at, rows["a"].last_reason, rows["a"].tripped_at) == (2, at(1), "two", at(3))
    log.clear("a", at(10))
    log.absorb(spark.createDataFrame([("a", at(11), "s", None, "four")], FAILURES))
    (row,) = log.states().collect()
    assert (row.scope, row.failures, row.last_reason, row.cleared_at, row.tripped_at) == ("a", 1, "four", at(10), None)
