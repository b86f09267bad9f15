"""Writes in batches of bounded size, each applied whole or not at all.

A task stages its rows and names what it staged; only the names that Spark's
commit protocol hands to the driver are applied, batch after batch. So a task that
fails leaves the target as it was, a speculative copy of a task stages rows that nobody
applies, and a crash between two batches leaves whole batches. What a task still
stages after the write was given up stays aside under the name of that run.
"""

from __future__ import annotations

import glob
import os
import shutil
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.model import Destination
from tidemark.sources.relational import quoted, quoted_table, upsert_statements


class BatchSink(Protocol):
    """Where batches go. It is pickled: ``stage`` runs on executors, the others on the driver's machine."""

    def stage(self, run: str, batch: str, rows: pa.RecordBatch) -> None:
        """Put the rows of a batch aside."""

    def apply(self, run: str, batch: str) -> None:
        """Apply a staged batch in one transaction; nothing happens if it was applied before."""

    def discard(self, run: str) -> None:
        """Remove what is still staged for a run."""

    def totals(self, run: str) -> tuple[int, int]:
        """Inserted and updated rows of the batches applied for a run."""


@dataclass
class Staged(WriterCommitMessage):
    batches: list[str]


def in_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``size``; the last one may have fewer."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while n + batch.num_rows >= size:
            held.append(batch.slice(0, size - n))
            batch = batch.slice(size - n)
            yield pa.concat_batches(held)
            held, n = [], 0
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
    if held:
        yield pa.concat_batches(held)


def write_batches(df: DataFrame, sink: BatchSink, batch_size: int = 250) -> tuple[int, int]:
    """Write ``df`` to ``sink``; returns inserted and updated rows. The driver gets the names of the staged batches only."""
    run, format_name = uuid.uuid4().hex, f"staged_{uuid.uuid4().hex}"

    class Writer(DataSourceArrowWriter):
        def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
            done = []
            for rows in in_batches(iterator, batch_size):
                done.append(uuid.uuid4().hex)
                sink.stage(run, done[-1], rows)
            return Staged(done)

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            for message in messages:
                for batch in message.batches if message else ():
                    sink.apply(run, batch)
            sink.discard(run)

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            sink.discard(run)

    class Target(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
            return Writer()

    df.sparkSession.dataSource.register(Target)
    df.write.format(format_name).mode("append").save()
    return sink.totals(run)


@dataclass
class FolderSink:
    """A stand-in for a database: a folder in which every applied batch is one Parquet file.

    A batch becomes visible by one rename. All rows count as inserted.
    """

    path: str

    def stage(self, run: str, batch: str, rows: pa.RecordBatch) -> None:
        os.makedirs(f"{self.path}/_staged/{run}", exist_ok=True)
        pq.write_table(pa.Table.from_batches([rows]), f"{self.path}/_staged/{run}/{batch}.parquet")

    def apply(self, run: str, batch: str) -> None:
        staged, applied = f"{self.path}/_staged/{run}/{batch}.parquet", f"{self.path}/{run}-{batch}.parquet"
        if not os.path.exists(applied):
            os.replace(staged, applied)

    def discard(self, run: str) -> None:
        shutil.rmtree(f"{self.path}/_staged/{run}", ignore_errors=True)

    def totals(self, run: str) -> tuple[int, int]:
        return sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{self.path}/{run}-*.parquet")), 0


@dataclass
class DatabaseSink:
    """Batches upserted into a table by a database client of the usual Python interface.

    ``connect`` opens a connection without autocommit. Table ``staging`` has the columns of the
    rows and ``run_id``, ``batch_id``. Every batch is one transaction that updates, inserts
    and takes its rows out of ``staging``; the counts go to table ``counts`` (run_id, inserted, updated) with it.
    """

    connect: Callable[[], Any]
    dialect: str
    table: str
    staging: str
    counts: str
    columns: Sequence[str]
    keys: Sequence[str]
    marker: str = "?"

    def _transaction(self, work: Callable[[Any], Any]) -> Any:
        connection = self.connect()
        try:
            found = work(connection.cursor())
            connection.commit()
            return found
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def stage(self, run: str, batch: str, rows: pa.RecordBatch) -> None:
        names = [quoted(c, self.dialect) for c in (*self.columns, "run_id", "batch_id")]
        insert = f"INSERT INTO {quoted_table(self.staging, self.dialect)} ({', '.join(names)}) VALUES ({', '.join([self.marker] * len(names))})"
        found = rows.select(list(self.columns)).to_pylist()
        self._transaction(lambda cursor: cursor.executemany(insert, [[*r.values(), run, batch] for r in found]))

    def apply(self, run: str, batch: str) -> None:
        staging, q = quoted_table(self.staging, self.dialect), lambda name: quoted(name, self.dialect)
        mine = f"{q('batch_id')} = '{batch}'"  # made here, letters and digits only
        names = ", ".join(map(q, self.columns))
        upsert = upsert_statements(self.dialect, self.table, f"(SELECT {names} FROM {staging} WHERE {mine})", self.columns, self.keys, subquery=True)

        def work(cursor: Any) -> None:
            cursor.execute(f"SELECT COUNT(*) FROM {staging} WHERE {mine}")
            rows = cursor.fetchone()[0]
            if not rows:
                return
            for text in upsert:
                cursor.execute(text)
            inserted = cursor.rowcount
            cursor.execute(f"DELETE FROM {staging} WHERE {mine}")
            cursor.execute(f"INSERT INTO {quoted_table(self.counts, self.dialect)} VALUES ('{run}', {inserted}, {rows - inserted})")

        self._transaction(work)

    def discard(self, run: str) -> None:
        text = f"DELETE FROM {quoted_table(self.staging, self.dialect)} WHERE {quoted('run_id', self.dialect)} = '{run}'"
        self._transaction(lambda cursor: cursor.execute(text))

    def totals(self, run: str) -> tuple[int, int]:
        def work(cursor: Any) -> tuple[int, int]:
            cursor.execute(f"SELECT SUM(inserted), SUM(updated) FROM {quoted_table(self.counts, self.dialect)} WHERE run_id = '{run}'")
            return tuple(int(n or 0) for n in cursor.fetchone())

        return self._transaction(work)


def batched_destination(id: str, sink_of: Callable[[str, Sequence[str], Sequence[str]], BatchSink], batch_size: int = 250, **options) -> Destination:
    """A destination of the sync cycle that applies changes in batches; ``sink_of`` gets table, columns and keys."""

    def deliver(changes: DataFrame, table: str, keys: Sequence[str]) -> tuple[int, int]:
        return write_batches(changes, sink_of(table, changes.columns, keys), batch_size)

    return Destination(id, deliver=deliver, **options)
