"""Bursts over a stream of failures, with their counts in streaming state.

The state store holds one row per scope and second, so a scope that takes all
failures is spread over tasks by the clock. A watermark of the window's width
drops failures that come too late to count, and the seconds that no failure can
fall into any more: the state holds the seconds of one width before the newest
failure (and what the last micro-batch added), whatever the stream has seen.

Every micro-batch writes the seconds it changed with their totals so far. Totals
only grow, so the largest one of a second is its last: a replayed epoch, or a
folder that was folded and not yet deleted, changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.failures import failure_burst
from tidemark.session import remove_path, subfolders
from tidemark.sources.tables import read_or_empty


def second_counts(failures: DataFrame, scope: Sequence[str], ts: str, hours: int) -> DataFrame:
    """scope, second, failures: counts per scope and second. On a stream, failures more than ``hours`` late are dropped."""
    late = failures.withWatermark(ts, f"{hours} hours")
    counted = late.groupBy(*scope, F.window(ts, "1 second").alias("_second")).agg(F.count(F.lit(1)).alias("failures"))
    return counted.select(*scope, F.col("_second.start").alias("second"), "failures")


class FailureCounts:
    """Seconds with failures, as a stream counted them, under ``root``.

    ``scope`` is the schema of the scope's columns. ``fold_every`` epochs are
    folded into one folder, so that folders do not pile up with short polls.
    """

    def __init__(self, spark: SparkSession, root: str, scope: T.StructType, hours: int = 1, threshold: int = 5, fold_every: int = 100):
        self.spark, self.root, self.scope = spark, root.rstrip("/"), scope
        self.hours, self.threshold, self.fold_every = hours, threshold, fold_every
        second = [T.StructField("second", T.TimestampType()), T.StructField("failures", T.LongType())]
        self.schema = T.StructType([*scope.fields, *second])

    def watch(self, failures: DataFrame, ts: str = "ts", poll: str | None = "2 seconds") -> StreamingQuery:
        """Count a stream of failures; ``ts`` is a timestamp. ``poll=None`` handles what is there and stops."""
        counted = second_counts(failures, self.scope.names, ts, self.hours)
        trigger = {"availableNow": True} if poll is None else {"processingTime": poll}
        writer = counted.writeStream.outputMode("update").foreachBatch(self.store).option("checkpointLocation", f"{self.root}/checkpoint")
        return writer.trigger(**trigger).start()

    def store(self, changed: DataFrame, epoch: int) -> None:
        """Write the seconds that an epoch changed; the same epoch again replaces them."""
        changed.select(self.schema.names).write.mode("overwrite").parquet(f"{self.root}/counts/epoch={epoch}")
        if (epoch + 1) % self.fold_every == 0:
            self.fold(epoch)

    def fold(self, epoch: int) -> None:
        """Put all epochs up to ``epoch`` into one folder."""
        old = [f for f in subfolders(self.spark, f"{self.root}/counts") if f.startswith("epoch=") and int(f.split("=")[1]) <= epoch]
        whole = f"{self.root}/folded/upto={epoch}"
        before = [f for f in subfolders(self.spark, f"{self.root}/folded") if f != f"upto={epoch}"]
        self.counts().hint("rebalance").write.mode("overwrite").parquet(whole)
        for folder in old:
            remove_path(self.spark, f"{self.root}/counts/{folder}")
        for folder in before:
            remove_path(self.spark, f"{self.root}/folded/{folder}")

    def counts(self) -> DataFrame:
        """One row per scope and second, with the number of failures in it."""
        parts = [read_or_empty(self.spark, f"{self.root}/{part}", self.schema).select(self.schema.names) for part in ("counts", "folded")]
        return parts[0].unionByName(parts[1]).groupBy(*self.scope.names, "second").agg(F.max("failures").alias("failures"))

    def bursts(self) -> DataFrame:
        """Per scope and second: failures in it, failures in the window that ends with it, and whether it trips."""
        return failure_burst(self.counts(), self.scope.names, "second", self.hours, self.threshold, n="failures")
