"""Compare a fingerprinted snapshot with what each destination last received.

State rows are ``stream_id, destination_id, key_hash, data_hash``. Keys that
vanish from a snapshot stay in the state and are never sent as deletes.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fingerprint import packed, unpacked

NEW, UPDATED = "NEW", "UPDATED"


HASHES = ("key_hash", "data_hash")


def with_packed(df: DataFrame) -> DataFrame:
    """``df`` with its hashes as bytes; those that are bytes already stay."""
    texts = [f for f in df.schema.fields if f.name in HASHES and isinstance(f.dataType, T.StringType)]
    return df.withColumns({f.name: packed(F.col(f.name), f.nullable) for f in texts}) if texts else df


def with_unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with its hashes as texts where they are texts in ``like``."""
    texts = [f.name for f in like.schema.fields if f.name in HASHES and isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: unpacked(F.col(name)) for name in texts if name in df.columns}) if texts else df


def join_state(snapshot: DataFrame, state: DataFrame, stream: str, destination: str) -> DataFrame:
    """Snapshot rows with ``known_hash``, NULL for a key never delivered."""
    known = state.where((F.col("stream_id") == stream) & (F.col("destination_id") == destination))
    known = known.select("key_hash", F.col("data_hash").alias("known_hash"))
    return snapshot.join(known, "key_hash", "left")


def classify(snapshot: DataFrame, state: DataFrame, stream: str, destination: str) -> DataFrame:
    """NEW and UPDATED rows for one destination; unchanged rows are dropped.

    Key hashes are uniform, so the one shuffle of the snapshot is even. Hashes travel as bytes.
    """
    joined = join_state(with_packed(snapshot), with_packed(state), stream, destination)
    changes = (
        joined.where(F.col("known_hash").isNull() | (F.col("known_hash") != F.col("data_hash")))
        .withColumn("change_kind", F.when(F.col("known_hash").isNull(), NEW).otherwise(UPDATED))
        .drop("known_hash")
    )
    return with_unpacked(changes, snapshot)


def in_line(versions: DataFrame) -> DataFrame:
    """Fingerprinted rows of several snapshots, told apart by ``moment``: each with what its key's line says about it.

    ``before`` is the data hash of the key's version before, NULL for the first; ``newest`` marks the
    last one and ``final_hash`` is its hash; ``copies`` is 2 for a row that repeats a key within a moment. One window over
    the key hash; the line of a key is sorted by one task, which spills, and is never collected.
    """
    line = Window.partitionBy("key_hash").orderBy(F.col("moment").asc_nulls_first())
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    again = (F.row_number().over(line) > 1) & F.lag("moment").over(line).eqNullSafe(F.col("moment"))
    return versions.withColumns(
        {
            "copies": F.when(again, 2).otherwise(1),
            "before": F.lag("data_hash").over(line),
            "newest": F.lead("data_hash").over(line).isNull(),
            "final_hash": F.last("data_hash").over(whole),
        }
    )


def classify_all(
    snapshot: DataFrame, state: DataFrame, streams: Mapping[str, str], every: Collection[str] | None = None
) -> DataFrame:
    """Changes for every destination in ``streams`` (destination id -> stream id).

    The state is folded to one row per key that holds a hash per destination
    (their number is a small configured list), so the snapshot is shuffled once
    for all of them and a row is repeated only for destinations that need it.
    A ``seq`` column in the state tells older hashes of a key from its last one;
    the fold then settles both questions in the aggregation the join needs anyway.
    Hashes travel as bytes; a snapshot whose hashes are bytes keeps them so.

    With ``every``, the snapshot holds several versions of a key (see :func:`in_line`). The
    destinations in it get each version that differs from the one before, the others the newest.
    """
    matches = [
        (F.col("stream_id") == s) & (F.col("destination_id") == d) for d, s in streams.items()
    ]
    age = F.col("seq") if "seq" in state.columns else F.lit(0)
    folded = (
        with_packed(state.where(reduce(lambda a, b: a | b, matches)))
        .groupBy("key_hash")
        .agg(
            *[
                F.max_by(F.when(match, F.col("data_hash")), F.when(match, age)).alias(f"_known_{i}")
                for i, match in enumerate(matches)
            ]
        )
    )
    joined = with_packed(snapshot).join(folded, "key_hash", "left")
    pending = []
    for i, (d, s) in enumerate(streams.items()):
        known = F.col(f"_known_{i}")
        if every is not None and d in every:
            known = F.coalesce("before", known)
        due = known.isNull() | (known != F.col("data_hash"))
        if every is not None and d not in every:
            due = due & F.col("newest")
        kind = F.when(known.isNull(), NEW).otherwise(UPDATED).alias("change_kind")
        pending.append(F.when(due, F.struct(F.lit(d).alias("destination_id"), F.lit(s).alias("stream_id"), kind)))
    pending = F.array(*pending)
    due = joined.withColumn("_to", F.explode(F.array_compact(pending))).select(*snapshot.columns, "_to.*")
    return with_unpacked(due, snapshot)


def change_counts(changes: DataFrame) -> DataFrame:
    """Number of NEW and UPDATED rows per destination."""
    return changes.groupBy("destination_id", "change_kind").agg(F.count(F.lit(1)).alias("changes"))


def commit(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State after delivery: changed keys replaced or added, all others kept."""
    ids = ["stream_id", "destination_id", "key_hash"]
    delivered = changes.select(*ids, "data_hash")
    held = with_packed(state.select(*ids, "data_hash")).join(with_packed(delivered).select(*ids), ids, "left_anti")
    return with_unpacked(held, state).select(*ids, "data_hash").unionByName(delivered)


def migrate(state: DataFrame, source: str, target: str) -> DataFrame:
    """State after stream ``source`` was renamed to ``target``.

    A destination already tracked under ``target`` keeps its own entries whole.
    Without a ``source`` stream nothing changes, so a second call is a no-op.
    """
    if source == target:
        return state
    tracked = state.where(F.col("stream_id") == target).select("destination_id").distinct()
    moved = (
        state.where(F.col("stream_id") == source)
        .join(tracked, "destination_id", "left_anti")
        .withColumn("stream_id", F.lit(target))
    )
    return state.where(F.col("stream_id") != source).unionByName(moved.select(*state.columns))


def state_summary(state: DataFrame) -> DataFrame:
    """Tracked keys per stream and destination."""
    return state.groupBy("stream_id", "destination_id").agg(F.count(F.lit(1)).alias("tracked"))
