"""Relational sources and sinks over Spark's JDBC connector.

Reading runs the whole SELECT in the source; with ``Split`` the source answers
in parallel ranges. Writing an upsert stages the changes with Spark's own JDBC
writer and then lets the server apply them in two set-based statements, instead
of one or two statements per row.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import plain_name
from tidemark.model import Destination
from tidemark.operators.quality import ConformanceError, assert_absent, canonical_keys


@dataclass(frozen=True)
class Split:
    """Parallel read: ``partitions`` ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class DepthRange:
    """Rows whose column lies from ``low`` to ``high``; the ends count as ``open_low`` and ``closed_high`` say. None is no bound.

    Without ``low`` the range also holds the rows without a value.
    """

    low: object = None
    high: object = None
    open_low: bool = False
    closed_high: bool = False

    @property
    def single(self) -> bool:
        return self.closed_high

    def column(self, value: Column) -> Column:
        """The range as a condition that is never NULL."""
        test = F.lit(True)
        if self.low is not None:
            test &= value > F.lit(self.low) if self.open_low else value >= F.lit(self.low)
        if self.high is not None:
            test &= value <= F.lit(self.high) if self.closed_high else value < F.lit(self.high)
        return F.coalesce(test, F.lit(False)) | value.isNull() if self.low is None else F.coalesce(test, F.lit(False))

    def predicate(self, column: str) -> str:
        """The range as a predicate for ``scan``; ``column`` is quoted by the caller."""
        tests = [] if self.low is None else [f"{column} {'>' if self.open_low else '>='} {literal(self.low)}"]
        tests += [] if self.high is None else [f"{column} {'<=' if self.closed_high else '<'} {literal(self.high)}"]
        text = " AND ".join(tests) or "1 = 1"
        return f"({text} OR {column} IS NULL)" if self.low is None and tests else text


def literal(value: object) -> str:
    """A number, text, date or timestamp as the servers known here write it."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str, dt.date)):
        raise ConformanceError(f"{value!r} cannot bound a range")
    if isinstance(value, (str, dt.date)):
        return "'" + str(value).replace("'", "''") + "'"
    return str(value)


def depth_ranges(rows: DataFrame, column: str, parts: int) -> list[DepthRange]:
    """About ``parts`` ranges with about as many rows each, in which every row lies once.

    The ends are quantiles of a sketch that Spark builds in one pass over the column, with an error of
    a hundredth of a range. A value that several quantiles hit is heavy and becomes a range of its
    own; nothing else is larger than its neighbours by more than the error.
    """
    if parts < 1:
        raise ConformanceError("a scan needs one range at least")
    shares = [k / parts for k in range(1, parts)]
    found = rows.select(F.percentile_approx(column, shares or [0.5], 100 * parts)).first()[0] if shares else None
    if not found:
        return [DepthRange()]
    hits = Counter(found)
    ranges, low, open_low = [], None, False
    for edge in sorted(hits):
        ranges.append(DepthRange(low, edge, open_low))
        low, open_low = edge, False
        if hits[edge] > 1:
            ranges.append(DepthRange(edge, edge, False, True))
            open_low = True
    return [*ranges, DepthRange(low, None, open_low)]


@dataclass(frozen=True)
class Connection:
    """JDBC address. ``options`` may carry driver, user, password, queryTimeout, fetchsize."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)


def select_text(sql: str) -> str:
    """SELECT text that can stand inside parentheses."""
    return sql.strip().strip(";").strip()


def read_options(
    connection: Connection, sql: str, split: Split | None = None, prepare: str | None = None
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``.

    ``prepare`` is the ``WITH ...`` prefix of a script, which cannot stand in
    a subquery on every server. Spark accepts ranges only with ``dbtable``.
    """
    options = {"url": connection.url, **connection.options}
    if prepare:
        options["prepareQuery"] = prepare.strip().lstrip(";").strip()
    if split is None:
        return {**options, "query": select_text(sql)}
    return {
        **options,
        "dbtable": f"({select_text(sql)}) extract",
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.partitions),
    }


def scan(
    spark: SparkSession,
    connection: Connection,
    sql: str,
    split: Split | None = None,
    prepare: str | None = None,
) -> DataFrame:
    """Lazy result of ``sql`` on the source."""
    return spark.read.format("jdbc").options(**read_options(connection, sql, split, prepare)).load()


def scan_ranges(
    spark: SparkSession, connection: Connection, sql: str, column: str, ranges: Sequence[DepthRange]
) -> DataFrame:
    """Lazy result of ``sql`` on the source, one task for each range of ``column`` (see :func:`depth_ranges`)."""
    options = dict(connection.options)
    predicates = [r.predicate(column) for r in ranges]
    return spark.read.jdbc(connection.url, f"({select_text(sql)}) extract", predicates=predicates, properties=options)


# Opening and closing identifier quotes per dialect.
IDENTIFIER_QUOTES = {"sqlserver": "[]", "postgresql": '""', "mysql": "``"}


def dialect_of(url: str) -> str:
    for name in IDENTIFIER_QUOTES:
        if url.startswith(f"jdbc:{name}:"):
            return name
    raise ValueError(f"no upsert statements are known for {url.split(':')[:2]}")


def quoted(name: str, dialect: str) -> str:
    opening, closing = IDENTIFIER_QUOTES[dialect]
    return opening + name.replace(closing, closing * 2) + closing


def table_parts(name: str) -> list[str]:
    """One to three parts of a table name, without the quotes they may come in."""
    parts = plain_name(name).split(".")
    if not parts[0] or len(parts) > 3:
        raise ConformanceError(f"{name!r} is not a table name of one to three parts")
    return parts


def quoted_table(name: str, dialect: str) -> str:
    return ".".join(quoted(part, dialect) for part in table_parts(name))


def upsert_statements(
    dialect: str, table: str, staging: str, columns: Sequence[str], keys: Sequence[str], subquery: bool = False
) -> list[str]:
    """Update rows that match on ``keys``, then insert those without a match.

    With ``subquery``, ``staging`` is a SELECT in parentheses and no table's name.

    Only the staged columns are written. Every target row with the key is
    updated; with key columns only there is nothing to set.
    """
    q = lambda name: quoted(name, dialect)
    target, source = quoted_table(table, dialect), staging if subquery else quoted_table(staging, dialect)
    same = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    rest = [c for c in columns if c not in keys]
    statements = []
    if rest:
        prefix = "" if dialect == "postgresql" else "t."
        assign = ", ".join(f"{prefix}{q(c)} = s.{q(c)}" for c in rest)
        statements.append(
            {
                "sqlserver": f"UPDATE t SET {assign} FROM {target} t JOIN {source} s ON {same}",
                "postgresql": f"UPDATE {target} t SET {assign} FROM {source} s WHERE {same}",
                "mysql": f"UPDATE {target} t JOIN {source} s ON {same} SET {assign}",
            }[dialect]
        )
    names = ", ".join(q(c) for c in columns)
    values = ", ".join(f"s.{q(c)}" for c in columns)
    statements.append(
        f"INSERT INTO {target} ({names}) SELECT {values} FROM {source} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {same})"
    )
    return statements


Transaction = Callable[[Sequence[str]], Sequence[int]]


def _stage(changes: DataFrame, connection: Connection, staging: str, batch_size: int) -> None:
    # the writer gets the name as the statements have it, else servers fold its case differently
    name = quoted_table(staging, dialect_of(connection.url))
    options = {"url": connection.url, "dbtable": name, "batchsize": str(batch_size), **connection.options}
    changes.write.format("jdbc").options(**options).mode("overwrite").save()


def jdbc_merge(
    changes: DataFrame,
    connection: Connection,
    table: str,
    staging: str,
    keys: Sequence[str],
    run_in_transaction: Transaction,
    auto_id: str | None = None,
    batch_size: int = 250,
) -> tuple[int, int]:
    """Stage ``changes`` in parallel, then apply them on the server in one transaction.

    ``run_in_transaction`` executes statements with whatever client the caller
    uses for that server and returns the rows each affected. Running it twice gives
    the same table, so a retry after a lost executor or driver is safe. Returns
    inserted and updated change rows; a change counts once however many rows it updates.
    """
    assert_absent(changes, auto_id)
    keys = canonical_keys(changes, keys)
    statements = upsert_statements(dialect_of(connection.url), table, staging, changes.columns, keys)
    count = changes.count()
    _stage(changes, connection, staging, batch_size)
    inserted = list(run_in_transaction(statements))[-1]
    return inserted, count - inserted


def append_statements(
    dialect: str, table: str, staging: str, columns: Sequence[str], batch_column: str | None, batch: str | None
) -> list[str]:
    """Insert all staged rows; with a batch column, what an earlier try of the batch left is deleted first."""
    names = ", ".join(quoted(c, dialect) for c in columns)
    target, source = quoted_table(table, dialect), quoted_table(staging, dialect)
    insert = f"INSERT INTO {target} ({names}) SELECT {names} FROM {source}"
    if batch_column is None:
        return [insert]
    if not re.fullmatch(r"[0-9A-Za-z-]+", batch or ""):
        raise ConformanceError(f"{batch!r} is not the name of a batch")
    return [f"DELETE FROM {target} WHERE {quoted(batch_column, dialect)} = '{batch}'", insert]


def jdbc_append(
    changes: DataFrame,
    connection: Connection,
    table: str,
    staging: str,
    run_in_transaction: Transaction,
    auto_id: str | None = None,
    batch_size: int = 250,
    batch_column: str | None = None,
    batch: str | None = None,
) -> tuple[int, int]:
    """History delivery: every staged version becomes a new row of ``table``.

    With ``batch_column`` the rows carry the name of their batch, and delivering
    a batch again replaces it; without, a retry after a crash repeats its rows.
    """
    assert_absent(changes, auto_id)
    if batch_column is not None:
        assert_absent(changes, batch_column)
        changes = changes.withColumn(batch_column, F.lit(batch))
    statements = append_statements(dialect_of(connection.url), table, staging, changes.columns, batch_column, batch)
    _stage(changes, connection, staging, batch_size)
    return list(run_in_transaction(statements))[-1], 0


def jdbc_destination(
    id: str,
    connection: Connection,
    staging: str,
    run_in_transaction: Transaction,
    mode: str = "upsert",
    table_override: str | None = None,
    auto_id: str | None = None,
    batch_size: int = 250,
    batch_column: str | None = None,
) -> Destination:
    """A destination of the sync cycle whose changes go to a table of a database."""
    if mode == "history":

        def deliver(changes: DataFrame, table: str, keys: Sequence[str], batch: str) -> tuple[int, int]:
            canonical_keys(changes, keys)
            return jdbc_append(changes, connection, table, staging, run_in_transaction, auto_id, batch_size, batch_column, batch)

    else:

        def deliver(changes: DataFrame, table: str, keys: Sequence[str]) -> tuple[int, int]:
            return jdbc_merge(changes, connection, table, staging, keys, run_in_transaction, auto_id, batch_size)

    return Destination(id, mode=mode, table_override=table_override, deliver=deliver, batched=mode == "history")
