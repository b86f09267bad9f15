"""What the operators share: inputs by position, written tables, row splits."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

# The white space of every word rule here.
BLANKS = r"[\x20\x09-\x0D]+"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own under the folder that all executors share."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or to a folder in it, and read it back.

    This cuts the lineage: what follows survives lost executors without
    computing ``df`` again, and Spark knows the size of what it reads.
    """
    spark = df.sparkSession
    path = f"{under}/{name}-{uuid.uuid4().hex}" if under else new_folder(spark, name)
    with narrow_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Texts go to Python workers in batches of so many bytes; the JVM and the worker hold several at once.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def narrow_batches(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside hand rows to Python in batches of ``BATCH_BYTES``, unless the session has set less."""
    before = spark.conf.get(BATCH_SETTING)
    if int(before.lower().rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of written tables that no plan reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lean(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``step`` for ``mapInArrow``; the worker, which waits for other tasks afterwards, gives back what Arrow and the C library keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run


def give_back() -> None:
    """Return freed memory of this process to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# So many narrow rows take some 100 MB on an executor.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table of narrow rows, broadcast if counted to be small; else Spark shuffles it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key's text, modulo ``n``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def lowest(df: DataFrame, key: str, share: float) -> DataFrame:
    """Rows whose keys hash into the lowest ``share`` of all hashes; every partition tells its own."""
    return df if share >= 1 else df.where(F.xxhash64(key) < F.lit(int((2 * share - 1) * 2**63)))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of ``key``: the same ones on every run.

    Only rows below a hash that about twice as many rows stay under are put in order;
    if fewer than ``rows`` do, as when keys repeat, the bound is raised.
    """
    total, share = df.count(), 1.0
    if total > 2 * rows:
        share = 2 * rows / total
        while share < 1 and lowest(df, key, share).count() < rows:
            share *= 2
    return lowest(df, key, share).orderBy(F.xxhash64(key), key).limit(rows)


def level(counts: list[int], rows: int) -> int:
    """The most rows a group may give so that all together give ``rows``; one at least, and small groups give all they have."""
    left = rows
    for k, n in enumerate(sorted(counts)):
        share = left // (len(counts) - k)
        if n > share:
            return max(share, 1)
        left -= n
    return max([1, *counts])


def different_rows(df: DataFrame, rows: int, by: str | None = None) -> DataFrame:
    """At most ``rows`` different rows of ``df``, those whose hashes over all columns are lowest: the same ones on every run.

    With ``by``, every value of it gives equally many, or all it has. Rows that repeat count
    once. Every partition tells the rows below a bound for itself; the driver gets only the hashes of
    about twice as many rows as are wanted, and from them the bound that gives as many.
    """
    kind = df.schema[by].dataType.simpleString() if by else "string"
    hashed = df.withColumns({"_of": F.col(by) if by else F.lit(""), "_hash": F.xxhash64(*df.columns)})
    counts = {r["_of"]: r["count"] for r in hashed.groupBy("_of").count().collect()}
    most = level(list(counts.values()), rows)
    share = {x: min(1.0, 2 * min(n, most) / n) for x, n in counts.items()}

    def below(bounds: dict) -> DataFrame:
        listed = df.sparkSession.createDataFrame(list(bounds.items()), f"_at {kind}, _bound long")
        return hashed.join(F.broadcast(listed), F.col("_of").eqNullSafe(F.col("_at")) & (F.col("_hash") <= F.col("_bound")))

    while True:
        seen: dict = {x: [] for x in counts}
        for r in below({x: min(2**63 - 1, int((2 * s - 1) * 2**63)) for x, s in share.items()}).select("_of", "_hash").distinct().collect():
            seen[r["_of"]].append(r["_hash"])
        short = [x for x, s in share.items() if s < 1 and len(seen[x]) < min(most, counts[x])]
        if not short:
            break
        share |= {x: min(1.0, 2 * share[x]) for x in short}
    bounds = {x: sorted(own)[:most][-1] for x, own in seen.items()}
    return below(bounds).dropDuplicates(["_of", "_hash"]).select(df.columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
