"""A SELECT that is polled, as a stream.

Spark's JDBC source does not stream. Here the offset is the number of the poll,
which follows the clock: it grows across restarts, polls that were missed while a
micro-batch ran are one, and nothing is read between two polls. A poll reads the
whole SELECT again in key ranges, one task each, and labels its rows with its number.
An offset that is replayed after a failure reads the same ranges under the same number;
rows are then as the source has them by now, which a sync may send, since it sends
what differs from the state and never deletes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.operators.quality import ConformanceError, assert_absent

# Runs the SELECT for keys from ``low`` on and below ``high``; None is open, and without ``low`` keys may be null.
ReadRange = Callable[[Any, Any], Iterator[pa.RecordBatch]]
POLL = "polled"


@dataclass
class KeyRange(InputPartition):
    low: Any
    high: Any
    poll: int


def key_ranges(edges: Sequence) -> list[tuple]:
    """Ranges between the edges, open at both ends: together they hold every key once."""
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ConformanceError("the edges of key ranges must grow")
    ends = [None, *edges, None]
    return list(zip(ends, ends[1:]))


def polled_stream(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    read_range: ReadRange,
    edges: Callable[[], Sequence],
    every: float = 2.0,
    clock: Callable[[], float] = time.time,
) -> DataFrame:
    """A stream of the polls of a SELECT: its columns, and ``polled``, the number of the poll.

    ``read_range`` runs on the executors and opens its own connection there; ``edges`` runs on the driver at
    every poll and says where the key ranges meet. ``name`` is the stream's name in the session. Use
    ``polled`` as the order of :func:`tidemark.streaming.loop.stream_sync`.
    """
    assert_absent(spark.createDataFrame([], schema), POLL)
    whole = T.StructType([*schema.fields, T.StructField(POLL, T.LongType())])

    class Reader(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"poll": 0}

        def latestOffset(self) -> dict:
            return {"poll": int(clock() // every)}

        def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
            return [KeyRange(low, high, end["poll"]) for low, high in key_ranges(edges())]

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            for batch in read_range(partition.low, partition.high):
                columns = [batch.column(f.name) for f in schema.fields]
                poll = pa.array([partition.poll] * batch.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, poll], whole.names)

        def commit(self, end: dict) -> None:
            pass

    class Polled(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return whole

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            return Reader()

    spark.dataSource.register(Polled)
    return spark.readStream.format(name).load()


def cursor_ranges(connect: Callable[[], Any], sql: str, key: str, schema: pa.Schema, marker: str = "?", rows: int = 10_000) -> ReadRange:
    """``read_range`` over a database client of the usual Python interface; bounds are bound, never pasted.

    ``connect`` opens a connection on an executor, ``key`` is the quoted key column of ``sql``.
    """

    def read(low: Any, high: Any) -> Iterator[pa.RecordBatch]:
        bounds = [(f"{key} >= {marker}", low)] if low is not None else []
        bounds += [(f"{key} < {marker}", high)] if high is not None else []
        tests = " AND ".join(test for test, _ in bounds)
        if low is None and tests:
            tests = f"({tests} OR {key} IS NULL)"
        connection = connect()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT * FROM ({sql.strip().strip(';')}) polled" + (f" WHERE {tests}" if tests else ""), [v for _, v in bounds])
            while found := cursor.fetchmany(rows):
                yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*found), schema)], schema.names)
        finally:
            connection.close()

    return read


def folder_ranges(path: str, key: str) -> ReadRange:
    """``read_range`` over a folder of Parquet files: a stand-in for a database."""

    def read(low: Any, high: Any) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        test = None
        if low is not None:
            test = ds.field(key) >= low
        if high is not None:
            below = ds.field(key) < high
            test = below | ds.field(key).is_null() if test is None else test & below
        yield from ds.dataset(path).to_batches(filter=test)

    return read
