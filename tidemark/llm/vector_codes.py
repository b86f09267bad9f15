"""Product codes for vectors, nearest entries found by Orchard's search (operator 13).

A vector is cut into equal parts, and every part is replaced by the number of the
nearest entry in the codebook of its position. Codebooks are refined by rounds of assigning and
averaging. All numbers are integers, so sums and ties come out the same in any order.

Orchard's search holds for every entry the list of all entries by distance from it. A
part starts at the first entry and walks that entry's list; as soon as an entry is
nearer, the walk jumps to the list of that one. Entries looked at once are marked and
not compared again. The walk ends when the next entry of the list is farther than twice the
current distance from the list's owner: by the triangle inequality none behind it can be nearer.
Many parts walk at once, each on its own list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, saved, small

SCALE = 256
MOST = 1 << 24  # magnitude of scaled components: squared distances and their sums fit 64 bits
BLOCK = 1_024  # vectors whose parts walk at once


class Codebook:
    """Entries of one position, with the neighbours of each by distance, of equal ones the lower number first."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.near = np.argsort(self.between, axis=1, kind="stable")
        self.apart = np.take_along_axis(self.between, self.near, axis=1)

    def distance(self, parts: np.ndarray, entry: np.ndarray | int) -> np.ndarray:
        return ((parts - self.entries[entry]) ** 2).sum(axis=1)

    def search(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest entry of every part, of equally near ones the lowest, and the squared distance."""
        n, size = len(parts), len(self.entries)
        best, error = np.zeros(n, np.int64), self.distance(parts, 0)
        marked = np.zeros((n, size), bool)
        marked[:, 0] = True
        step = np.zeros(n, np.int64)
        walking = np.arange(n)
        while len(walking):
            owner, at = best[walking], step[walking]
            going = self.apart[owner, at] <= 4 * error[walking]  # squared: twice the distance
            walking, owner, at = walking[going], owner[going], at[going]
            step[walking] += 1
            entry = self.near[owner, at]
            new = ~marked[walking, entry]
            some, entry = walking[new], entry[new]
            marked[some, entry] = True
            distance = self.distance(parts[some], entry)
            nearer = (distance < error[some]) | ((distance == error[some]) & (entry < best[some]))
            some = some[nearer]
            best[some], error[some], step[some] = entry[nearer], distance[nearer], 0
            walking = walking[step[walking] < size]
        return best, error


def scaled(batch: pa.RecordBatch, parts: int, width: int) -> np.ndarray:
    """Vectors of a batch as integers: row, position, place in the part."""
    vector = batch.column("vector")
    if not len(vector):
        return np.zeros((0, parts, width), np.int64)
    flat = vector.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(vector) * parts * width:
        raise ValueError(f"vectors must all have {parts * width} components")
    whole = np.floor(SCALE * flat)
    if np.abs(whole).max() > MOST:
        raise ValueError(f"components beyond {MOST // SCALE} have no exact codes")
    return whole.astype(np.int64).reshape(len(vector), parts, width)


def assigned(vectors: np.ndarray, books: list[Codebook]) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Blocks of vectors with the codes of their parts and the squared distances."""
    for at in range(0, len(vectors), BLOCK):
        block = slice(at, at + BLOCK)
        found = [book.search(vectors[block, k]) for k, book in enumerate(books)]
        yield block, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def refined(rows: DataFrame, books: list[Codebook]) -> list[Codebook]:
    """Codebooks whose entries are the rounded down means of the parts assigned to them; unused entries stay."""
    spark, (size, width) = rows.sparkSession, books[0].entries.shape
    shared = spark.sparkContext.broadcast([b.entries for b in books])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Codebook(e) for e in shared.value]
        sums, counts = np.zeros((len(own) * size, width), np.int64), np.zeros(len(own) * size, np.int64)
        first = np.arange(len(own)) * size
        for batch in batches:
            vectors = scaled(batch, len(own), width)
            for block, codes, _ in assigned(vectors, own):
                place = (codes + first).ravel()
                np.add.at(sums, place, vectors[block].reshape(-1, width))
                counts += np.bincount(place, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["entry", "n", "sums"]
        )

    found = rows.select("vector").mapInArrow(lean(total), "entry int, n long, sums array<long>")
    columns = [F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width))]
    entries = np.concatenate([b.entries for b in books])
    for r in found.groupBy("entry").agg(*columns).collect():  # at most as many rows as there are entries
        entries[r["entry"]] = [r[f"s{k}"] // r["n"] for k in range(width)]
    return [Codebook(entries[k * size : (k + 1) * size]) for k in range(len(books))]


def digest(books: list[Codebook]) -> str:
    """SHA-256 of all components as decimal text by position, entry and place."""
    text = ",".join(str(x) for book in books for x in book.entries.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def usable(vector) -> F.Column:
    """Whether a vector is there, has components, and all of them are finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def compress(
    df: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2
) -> DataFrame:
    """One row per usable vector: key, code, error, label_error, codebooks_sha256.

    Components count as floor(256 x). The codebook of a position starts as that part of the
    vectors with the ``entries`` smallest keys (of equal keys, the smaller vector first; null keys
    last) and is refined in ``rounds`` rounds. ``code`` has two hexadecimal digits for each
    part, ``error`` is the squared distance to the entries, ``label_error`` its sum over rows with
    the same label, null being one of them.

    Rows whose vector is null, empty, or has a null, infinite or undefined component are left out.
    Vectors must have one length, divisible by ``parts``, and components of up to 65,536 in
    magnitude; others are an error. Rows that repeat are kept. With
    fewer rows than ``entries`` codebooks are as short. Other columns are not looked at. An empty input
    gives an empty result.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two digits number up to 256 entries")
    rows = df.select(df[key].alias("id"), df[vector].alias("vector"), df[label].alias("label"))
    rows = rows.where(usable(F.col("vector")))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not first:
        return rows.select(F.col("id").alias(key), *[F.lit(None).cast(t).alias(n) for n, t in
                           (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    width, rest = divmod(len(first[0].vector), parts)
    if rest:
        raise ValueError(f"vectors of {len(first[0].vector)} components have no {parts} equal parts")
    start = scaled(pa.RecordBatch.from_arrays([pa.array([r.vector for r in first], pa.list_(pa.float64()))], ["vector"]), parts, width)
    books = [Codebook(np.ascontiguousarray(start[:, k])) for k in range(parts)]
    for _ in range(rounds):
        books = refined(rows, books)
    shared = df.sparkSession.sparkContext.broadcast([b.entries for b in books])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Codebook(e) for e in shared.value]
        for batch in batches:
            codes, errors = [], []
            for _, code, error in assigned(scaled(batch, parts, width), own):
                codes += [row.tobytes().hex() for row in code.astype(np.uint8)]
                errors.append(error.sum(axis=1))
            error = pa.array(np.concatenate(errors) if errors else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), error], ["id", "label", "code", "error"])

    found = saved(rows.mapInArrow(lean(coded), f"id {kinds['id']}, label {kinds['label']}, code string, error long"), "vector-codes")
    sums = small(saved(found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "vector-labels"))
    out = found.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
