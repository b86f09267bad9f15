import pytest

from tidemark.model import SyncJob
from tidemark.operators.quality import ConformanceError
from tidemark.plans.sync import Workspace, run_cycle
from tidemark.sources import relational
from tidemark.sources.relational import (
    Connection,
    Split,
    dialect_of,
    jdbc_destination,
    jdbc_merge,
    read_options,
    select_text,
    upsert_statements,
)

SERVER = Connection("jdbc:postgresql://db/erp", {"user": "reader", "queryTimeout": "60"})


def test_whole_query_runs_in_the_source():
    options = read_options(SERVER, "SELECT id, name FROM staff;\n")
    assert options == {"url": SERVER.url, "user": "reader", "queryTimeout": "60", "query": "SELECT id, name FROM staff"}
    assert select_text(" ;SELECT 1; ") == "SELECT 1"


def test_parallel_ranges_and_prefix():
    options = read_options(SERVER, "SELECT * FROM base;", Split("id", "1", "1000", 8), prepare=";WITH base AS (SELECT 1 AS id)")
    assert options["dbtable"] == "(SELECT * FROM base) extract"
    assert options["prepareQuery"] == "WITH base AS (SELECT 1 AS id)"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "1000", "8")
    assert "query" not in options


@pytest.mark.parametrize(
    "dialect, update",
    [
        ("sqlserver", "UPDATE t SET t.[name] = s.[name] FROM [dbo].[staff] t JOIN [stage] s ON t.[id] = s.[id]"),
        ("postgresql", 'UPDATE "dbo"."staff" t SET "name" = s."name" FROM "stage" s WHERE t."id" = s."id"'),
        ("mysql", "UPDATE `dbo`.`staff` t JOIN `stage` s ON t.`id` = s.`id` SET t.`name` = s.`name`"),
    ],
)
def test_upsert_statements(dialect, update):
    found = upsert_statements(dialect, "dbo.staff", "stage", ["id", "name"], ["id"])
    assert found[0] == update
    assert len(found) == 2 and "WHERE NOT EXISTS" in found[1]


def test_keys_only_never_update_and_quotes_are_doubled():
    found = upsert_statements("mysql", "t", "s", ["a`b"], ["a`b"])
    assert len(found) == 1 and "`a``b`" in found[0]


def test_dialects():
    assert dialect_of("jdbc:mysql://h/db") == "mysql"
    with pytest.raises(ValueError):
        dialect_of("jdbc:other:x")


def test_merge_refuses_generated_ids_and_missing_keys(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(ConformanceError):
        jdbc_merge(df, SERVER, "staff", "stage", ["id"], lambda s: None, auto_id="ID")
    with pytest.raises(ConformanceError):
        jdbc_merge(df, SERVER, "staff", "stage", ["nope"], lambda s: None)


def test_table_names_lose_their_quotes_and_have_three_parts_at_most():
    found = upsert_statements("sqlserver", "[dbo].[staff]", '"Stage"', ["id"], ["id"])
    assert found[0].startswith("INSERT INTO [dbo].[staff] ([id]) SELECT s.[id] FROM [Stage] s")
    for name in ("a.b.c.d", " . ", ""):
        with pytest.raises(ConformanceError):
            upsert_statements("mysql", name, "s", ["a"], ["a"])


class Server:
    """Stands in for a database: keeps what is staged and the statements, and answers with given row counts."""

    def __init__(self, monkeypatch, *counts):
        self.staged, self.statements, self.counts = [], [], list(counts)
        monkeypatch.setattr(relational, "_stage", lambda df, connection, staging, batch: self.staged.append(sorted(map(tuple, df.collect()), key=str)))

    def __call__(self, statements):
        self.statements.append(list(statements))
        answer = self.counts.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer


def cycle(spark, work, destination, *rows):
    df = spark.createDataFrame(list(rows), "id int, name string")
    (m,) = run_cycle(work, [SyncJob("people", lambda _: df, "dbo.staff", ["ID"])], [destination])
    return m["changes"], m["inserted"], m["updated"], m["errors"]


def test_upsert_through_a_cycle(spark, folder, monkeypatch):
    # 3 target rows updated by 1 change, 2 inserted
    server, work = Server(monkeypatch, [3, 2], OSError("down"), [1, 0]), Workspace(spark, f"{folder}/work")
    to = jdbc_destination("erp", SERVER, "stage.staff", server)
    assert cycle(spark, work, to, (1, "A"), (2, "B"), (3, "C")) == (3, 2, 1, 0)
    assert cycle(spark, work, to, (1, "A"), (2, "B"), (3, "C")) == (0, 0, 0, 0)
    assert cycle(spark, work, to, (1, "A2"), (2, "B"), (3, "C")) == (1, 0, 0, 1)
    assert cycle(spark, work, to, (1, "A2"), (2, "B"), (3, "C")) == (1, 0, 1, 0)
    assert server.staged == [[(1, "A"), (2, "B"), (3, "C")], [(1, "A2")], [(1, "A2")]]
    assert server.statements[0][0].startswith('UPDATE "dbo"."staff" t SET "name" = s."name" FROM "stage"."staff" s')


def test_history_through_a_cycle(spark, folder, monkeypatch):
    server, work = Server(monkeypatch, OSError("lost"), [0, 1], [0, 1]), Workspace(spark, f"{folder}/work")
    to = jdbc_destination("log", SERVER, "stage", server, mode="history", batch_column="batch")
    assert cycle(spark, work, to, (1, "A")) == (1, 0, 0, 1)
    assert cycle(spark, work, to, (1, "A")) == (1, 1, 0, 0)
    assert cycle(spark, work, to, (1, "B")) == (1, 1, 0, 0)
    first, again, other = ([row[2] for row in rows][0] for rows in server.staged)
    assert first == again != other
    assert server.statements[1][0] == f"""DELETE FROM "dbo"."staff" WHERE "batch" = '{again}'"""
    assert server.statements[1][1].startswith('INSERT INTO "dbo"."staff" ("id", "name", "batch") SELECT')


def test_the_writer_gets_the_name_as_the_statements_have_it(spark, monkeypatch):
    seen = {}

    class Writer:
        def format(self, kind):
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def mode(self, _):
            return self

        def save(self):
            pass

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: Writer()))
    relational._stage(spark.range(1), SERVER, "[Stage].Staff", 250)
    assert seen["dbtable"] == '"Stage"."Staff"' and seen["batchsize"] == "250"
