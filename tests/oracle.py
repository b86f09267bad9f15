"""Compare registered queries with their SQL in DuckDB.

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


# Spark and DuckDB names of the types that results use.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> str | None:
    """None when both agree, else what differs."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = dict(zip(names, [str(d[1]) for d in result.description]))
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        wanted = TYPES.get(spark_type, spark_type.upper())
        if wanted.replace(" ", "") != kinds[field.name].replace(" ", ""):
            return f"type of {field.name}: {spark_type} vs {kinds[field.name]}"
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if actual != expected:
        return (
            f"{sum(actual.values())} rows vs {sum(expected.values())}; only in Spark "
            f"{list((actual - expected).items())[:2]}; only in SQL {list((expected - actual).items())[:2]}"
        )
    return None if expected else "no rows, the comparison says nothing"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    wrong = 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, query, sql[name]) if name in sql else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
