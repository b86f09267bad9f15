"""Line deduplication with two Bloom filters (operator 12).

1. Every task hashes the keys of its lines and notes which bits of a filter they set
   once and which twice. Segments of both filters meet by number: a bit that two tasks
   have set, or one of them twice, is set in the second filter.
2. A line is suspected of being repeated if the second filter has all its bits. Only
   suspects are shuffled, with their full keys: that confirms how many documents hold a
   key and chooses the one that keeps it.
3. Keys that go are joined to the documents that lose them, which are then put together
   again line by line.

The filters only save work: any line that stands in two documents is a suspect, and a
filter that is too full gives more suspects and the same result. They have
``bits_per_line`` bits for every line counted, up to ``most_bits``, so what is broadcast is
bounded; beyond that all lines are suspects in the end, which costs one shuffle of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, saved, small

STRIPPED = b" \t\n\x0b\x0c\r"  # fixed values: what is stripped from both ends of a line
HELD = 1_000_000  # hashes that a task holds before it hands on their bits


def keys_of(text: bytes | None, shortest: int) -> list[bytes | None]:
    """The key of every line of a text in UTF-8; None for keys of under ``shortest`` code points."""
    keys: list[bytes | None] = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(STRIPPED).lower()  # of bytes: A-Z only
        enough = len(key) >= shortest and (len(key) >= 4 * shortest or len(key.decode("utf-8", "replace")) >= shortest)
        keys.append(key if enough else None)
    return keys


def bits(keys: set[bytes], size: int) -> np.ndarray:
    """The two bits of each key in a filter of ``size`` bits, a row for each key."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    return np.stack([hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)], axis=1).astype(np.int64) % size


def noted(places: list[np.ndarray], segment_bits: int) -> Iterator[pa.RecordBatch]:
    """Bits set once or more, and twice or more, by segment of 2 ** ``segment_bits`` bits."""
    once, n = np.unique(np.concatenate(places), return_counts=True)
    twice = n > 1
    first = once >> segment_bits
    cuts = np.flatnonzero(np.diff(first, prepend=-1))
    inside = (once & ((1 << segment_bits) - 1)).astype(np.int32)
    rows = [(int(first[a]), inside[a:b].tobytes(), inside[a:b][twice[a:b]].tobytes()) for a, b in zip(cuts, [*cuts[1:], len(once)])]
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))]
    yield pa.RecordBatch.from_arrays(columns, ["segment", "once", "twice"])


def second_filter(texts: DataFrame, shortest: int, size: int, segment_bits: int) -> dict[int, bytes]:
    """The packed bits of the filter of what was seen twice, by segment; segments without any are left out."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, held = [], 0
        for batch in batches:
            for text in batch.column("text"):
                places.append(bits(set(filter(None, keys_of(text.as_py(), shortest))), size).ravel())
                held += len(places[-1])
                if held > HELD:
                    yield from noted(places, segment_bits)
                    places, held = [], 0
        if held:
            yield from noted(places, segment_bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice"))))
        for segment, own in groupby(rows, key=itemgetter(0)):  # sorted, so one segment at a time
            first, second = np.zeros(1 << segment_bits, bool), np.zeros(1 << segment_bits, bool)
            for _, once, twice in own:
                places = np.frombuffer(once, np.int32)
                second[places[first[places]]] = True
                second[np.frombuffer(twice, np.int32)] = True
                first[places] = True
            if second.any():
                packed = zlib.compress(np.packbits(second).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([packed], pa.binary())], ["segment", "bits"])

    noted_bits = texts.mapInArrow(lean(seen), "segment int, once binary, twice binary")
    dealt = noted_bits.repartition("segment").sortWithinPartitions("segment")
    return {r.segment: bytes(r.bits) for r in dealt.mapInArrow(lean(merge), "segment int, bits binary").collect()}


def suspects_of(rows: DataFrame, shortest: int, size: int, segment_bits: int, segments: dict[int, bytes]) -> DataFrame:
    """id, key: once for each row and key that the second filter has."""
    shared = rows.sparkSession.sparkContext.broadcast(segments)
    kind = rows.schema["id"].dataType.simpleString()

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.zeros(size >> 3, np.uint8)
        for segment, own in shared.value.items():
            at = segment << (segment_bits - 3)
            packed[at : at + (1 << (segment_bits - 3))] = np.frombuffer(zlib.decompress(own), np.uint8)
        for batch in batches:
            owner, keys = [], []
            for k, text in enumerate(batch.column("text")):
                own = set(filter(None, keys_of(text.as_py(), shortest)))
                places = bits(own, size)
                hit = ((packed[places >> 3] >> (7 - (places & 7))) & 1).all(axis=1)
                found = [key for key, is_hit in zip(own, hit) if is_hit]
                keys += found
                owner += [k] * len(found)
            ids = batch.column("id").take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary())], ["id", "key"])

    return rows.mapInArrow(lean(suspect), f"id {kind}, key binary")


def drop_lines(
    df: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = 20, least: int = 3,
    bits_per_line: int = 16, most_bits: int = 1 << 30, segment_bits: int = 20,
) -> DataFrame:
    """One row per input row: key, n_lines, n_dropped, text (what stays).

    A line's key is the line without blanks at both ends and with A-Z in lower case. Keys of
    ``shortest`` code points that stand in ``least`` rows lose all their lines but those in the
    row with the largest ``key``. Other lines stay as they are, joined by newlines.

    Null and empty texts are one empty line. Every row counts as a document of its own; of
    rows that share the largest key all keep their lines. Null keys are never largest; lines that
    only rows with null keys hold stay in all of them. Other columns are not looked at. An
    empty input gives an empty result.
    """
    rows = df.select(df[key].alias("id"), F.coalesce(df[text], F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    body = F.coalesce(df[text], F.lit(""))
    lines = df.agg(F.sum(F.length(body) - F.length(F.replace(body, F.lit("\n"))) + 1)).first()[0] or 0
    size = 1 << max(segment_bits, min(most_bits, bits_per_line * lines - 1).bit_length())
    segments = second_filter(rows.select("text"), shortest, size, segment_bits)
    found = saved(suspects_of(rows, shortest, size, segment_bits, segments), "lines-suspected")
    digest = F.unhex(F.sha2("key", 256)).alias("digest")
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep_id")).where(F.col("n") >= least)
    repeated = small(saved(repeated.select(digest, "keep_id"), "lines-repeated"))
    lost = found.withColumn("digest", digest).join(repeated, "digest").where(beaten(F.col("id"), F.col("keep_id")))
    gone = saved(lost.groupBy("id").agg(F.collect_set("key").alias("gone")), "lines-gone")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], []
            for text, gone in zip(batch.column("text"), batch.column("gone")):
                raw = text.as_py()
                dropped = set(gone.as_py()) if gone.is_valid else None
                stay = raw.split(b"\n")
                total = len(stay)
                if dropped:
                    stay = [line for line, k in zip(stay, keys_of(raw, shortest)) if k is None or k not in dropped]
                    raw = b"\n".join(stay)
                counts.append((total, total - len(stay)))
                texts.append(raw)
            numbers = [pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *numbers, pa.array(texts, pa.binary())], ["id", "n_lines", "n_dropped", "text"])

    losing = gone.select(F.col("id").alias("of"), "gone")
    whole = rows.join(losing, F.col("id").eqNullSafe(F.col("of")), "left").select("id", "text", "gone")
    kept = whole.mapInArrow(lean(keep), f"id {kind}, n_lines long, n_dropped long, text binary")
    return kept.select(F.col("id").alias(key), "n_lines", "n_dropped", F.col("text").cast("string").alias("text"))


def beaten(own: Column, keeper: Column) -> Column:
    """Whether a row is not the one that keeps a line; null is smaller than any key."""
    return keeper.isNotNull() & ~own.eqNullSafe(keeper)
