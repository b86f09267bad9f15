"""Change detection, delivery and state over snapshots of the line items.

The source keeps lines of a rolling period. The earlier snapshot ends with 1999
and the later one starts with 1996, so keys are new, changed, equal or gone
between them, and together they cover the whole table. Each is the latest row
per (order, line).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fingerprint import batch_id, fingerprint, stream_id, with_fingerprints
from tidemark.model import Destination, SyncJob
from tidemark.operators.audit import audit_flags
from tidemark.operators.changes import change_counts, classify, classify_all, commit, migrate, state_summary
from tidemark.operators.latest import keep_latest, newest_first
from tidemark.operators.merge import apply_counts, exists_in, match_target, merge_upsert
from tidemark.operators.reports import distinct_sketches, united_distincts
from tidemark.plans.sync import Workspace, run_cycle, through_table
from tidemark.session import shared_folder
from tidemark.sources.failure_log import FailureLog
from tidemark.sources.polled import folder_ranges, polled_stream
from tidemark.sources.relational import depth_ranges
from tidemark.sources.staged import FolderSink, write_batches
from tidemark.sources.tables import UpsertTable, read_history
from tidemark.streaming.failure_counts import FailureCounts
from tidemark.streaming.failure_state import failure_state
from tidemark.streaming.loop import stream_sync
from workload.registry import SQL, fingerprint_sql, query, table
from workload.report_queries import LINE_KEYS, LINE_ORDER

COLUMNS = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity", "l_returnflag"]
DECIMALS = {"l_quantity": (12, 2)}
EARLIER, LATER = "l_shipdate < '2000-01-01'", "l_shipdate >= '1996-01-01'"

STREAM = stream_id("lines", "erp_lines", LINE_KEYS)
ARCHIVE_STREAM = stream_id("lines", "archive_lines", LINE_KEYS)


def snapshot(spark, sf, period: str):
    lines = table(spark, sf, "lineitem").where(period)
    return keep_latest(lines, LINE_KEYS, newest_first(*LINE_ORDER)).select(*COLUMNS)


def hashed(df):
    return with_fingerprints(df, LINE_KEYS, DECIMALS)


def state_of(df, stream: str, destination: str):
    return hashed(df).select(
        F.lit(stream).alias("stream_id"), F.lit(destination).alias("destination_id"), "key_hash", "data_hash"
    )


def line_changes(spark, sf):
    state = state_of(snapshot(spark, sf, EARLIER), STREAM, "erp")
    return classify(hashed(snapshot(spark, sf, LATER)), state, STREAM, "erp")


def _snapshot_sql(period: str) -> str:
    period = period.replace("'2", "TIMESTAMP '2").replace("'1", "TIMESTAMP '1")
    return f"""SELECT {", ".join(COLUMNS)} FROM lineitem WHERE {period}
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1"""


KEY_SQL = fingerprint_sql(**{c: ("i", f"CAST(l.{c} AS VARCHAR)") for c in LINE_KEYS})
DATA_SQL = fingerprint_sql(
    l_orderkey=("i", "CAST(l.l_orderkey AS VARCHAR)"),
    l_linenumber=("i", "CAST(l.l_linenumber AS VARCHAR)"),
    l_shipdate=("t", "CAST(l.l_shipdate AS VARCHAR)"),
    l_partkey=("i", "CAST(l.l_partkey AS VARCHAR)"),
    l_quantity=("n", "CAST(CAST(l.l_quantity AS DECIMAL(12,2)) AS VARCHAR)"),
    l_returnflag=("s", "l.l_returnflag"),
)

# Changes are stated by comparing columns; hashes play no part.
CHANGES_SQL = f"""
    earlier AS ({_snapshot_sql(EARLIER)}),
    later AS ({_snapshot_sql(LATER)}),
    changes AS (
      SELECT l.*, CASE WHEN e.l_orderkey IS NULL THEN 'NEW' ELSE 'UPDATED' END AS change_kind
      FROM later l LEFT JOIN earlier e ON e.l_orderkey = l.l_orderkey AND e.l_linenumber = l.l_linenumber
      WHERE e.l_orderkey IS NULL OR (e.l_shipdate, e.l_partkey, e.l_quantity, e.l_returnflag)
                                 IS DISTINCT FROM (l.l_shipdate, l.l_partkey, l.l_quantity, l.l_returnflag))
"""


@query("classify_changes", f"WITH {CHANGES_SQL} SELECT * FROM changes")
def classify_changes(spark, sf):
    return line_changes(spark, sf).select(*COLUMNS, "change_kind")


STREAMS = {"erp": STREAM, "archive": ARCHIVE_STREAM, "mirror": STREAM}


def fanout(spark, sf):
    state = state_of(snapshot(spark, sf, EARLIER), STREAM, "erp").unionByName(
        state_of(snapshot(spark, sf, EARLIER), ARCHIVE_STREAM, "archive")
    )
    return classify_all(hashed(snapshot(spark, sf, LATER)), state, STREAMS)


FANOUT_SQL = f"""
    erp AS ({_snapshot_sql(EARLIER)}),
    archive AS ({_snapshot_sql(EARLIER)}),
    later AS ({_snapshot_sql(LATER)}),
    known AS (SELECT 'erp' AS destination_id, * FROM erp UNION ALL SELECT 'archive', * FROM archive),
    destinations(destination_id, stream_id) AS (VALUES ('erp', '{STREAM}'), ('archive', '{ARCHIVE_STREAM}'), ('mirror', '{STREAM}')),
    changes AS (
      SELECT l.*, d.destination_id, d.stream_id, CASE WHEN k.l_orderkey IS NULL THEN 'NEW' ELSE 'UPDATED' END AS change_kind
      FROM later l CROSS JOIN destinations d
      LEFT JOIN known k ON k.destination_id = d.destination_id AND k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber
      WHERE k.l_orderkey IS NULL OR (k.l_shipdate, k.l_partkey, k.l_quantity, k.l_returnflag)
                                 IS DISTINCT FROM (l.l_shipdate, l.l_partkey, l.l_quantity, l.l_returnflag))
"""


@query(
    "fanout_changes",
    f"WITH {FANOUT_SQL} SELECT l_orderkey, l_linenumber, l_shipdate, destination_id, stream_id, change_kind FROM changes",
)
def fanout_changes(spark, sf):
    return fanout(spark, sf).select(*LINE_KEYS, "l_shipdate", "destination_id", "stream_id", "change_kind")


@query(
    "change_counts",
    f"WITH {FANOUT_SQL} SELECT destination_id, change_kind, count(*) AS changes FROM changes GROUP BY ALL",
)
def change_counts_query(spark, sf):
    return change_counts(fanout(spark, sf))


@query(
    "audit_flags",
    f"""
    WITH {FANOUT_SQL}
    SELECT l_shipdate AS ts, CAST(l_shipdate AS DATE) AS event_date, stream_id, 'lines' AS origin,
           destination_id AS destination, change_kind AS event,
           left({KEY_SQL}, 24) AS row_fingerprint, left({DATA_SQL}, 24) AS data_fingerprint
    FROM changes l
    """,
)
def audit_flags_query(spark, sf):
    return audit_flags(fanout(spark, sf), "lines", F.col("l_shipdate"))


SUPPLIED = ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag"]


@query(
    "merge_upsert",
    f"""
    WITH {CHANGES_SQL}
    SELECT t.l_orderkey, t.l_linenumber, coalesce(c.l_shipdate, t.l_shipdate) AS l_shipdate, t.l_partkey,
           coalesce(c.l_quantity, t.l_quantity) AS l_quantity,
           CASE WHEN c.l_orderkey IS NULL THEN t.l_returnflag ELSE nullif(c.l_returnflag, 'R') END AS l_returnflag,
           'kept' AS note
    FROM earlier t LEFT JOIN changes c ON c.l_orderkey = t.l_orderkey AND c.l_linenumber = t.l_linenumber
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_shipdate, NULL, l_quantity, nullif(l_returnflag, 'R'), 'default'
    FROM changes WHERE change_kind = 'NEW'
    """,
)
def merge_upsert_query(spark, sf):
    target = snapshot(spark, sf, EARLIER).withColumn("note", F.lit("kept"))
    changes = line_changes(spark, sf).select(*SUPPLIED)
    changes = changes.withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("R")))
    # staged as in the cycle: the merge reads its changes three times
    changes = through_table(changes, f"{shared_folder(spark)}/changes-{uuid.uuid4().hex}")
    return merge_upsert(target, changes, LINE_KEYS, {"note": F.lit("default")})


# A change for every part; the target holds the lines of the suppliers, whose numbers end before those of the parts.
MATCH_SQL = """
    SELECT p_partkey AS number, p_size,
           CASE WHEN p_partkey IN (SELECT l_suppkey FROM lineitem) THEN 'update' ELSE 'insert' END AS apply_action
    FROM part
"""


def _matched(spark, sf):
    changes = table(spark, sf, "part").select(F.col("p_partkey").alias("number"), "p_size")
    return changes, table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "number")


@query("match_target", MATCH_SQL)
def match_target_query(spark, sf):
    return match_target(*_matched(spark, sf), ["number"])


@query(
    "apply_counts",
    f"""
    SELECT count(*) FILTER (apply_action = 'insert') AS inserted, count(*) FILTER (apply_action = 'update') AS updated
    FROM ({MATCH_SQL})
    """,
)
def apply_counts_query(spark, sf):
    return apply_counts(match_target(*_matched(spark, sf), ["number"]))


@query("exists_in", f"SELECT number, p_size FROM ({MATCH_SQL}) WHERE apply_action = 'update'")
def exists_in_query(spark, sf):
    return exists_in(*_matched(spark, sf), ["number"])


@query(
    "merge_mixed_case",
    """
    SELECT s_suppkey, coalesce(c_name, s_name) AS s_name, s_nationkey, coalesce(c_acctbal, s_acctbal) AS s_acctbal
    FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey
    UNION ALL
    SELECT c_custkey, c_name, NULL, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
    """,
)
def merge_mixed_case(spark, sf):
    """Customers as changes to suppliers, with column names in another case."""
    target = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    changes = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("S_SuppKey"), F.col("c_name").alias("S_NAME"), F.col("c_acctbal").alias("s_AcctBal")
    )
    return merge_upsert(target, changes, ["S_SUPPKEY"])


@query(
    "merge_collated_keys",
    """
    SELECT c_name, coalesce(s_acctbal, c_acctbal) AS c_acctbal, c_mktsegment
    FROM customer LEFT JOIN supplier ON lower(c_name) = 'customer#' || lpad(CAST(s_suppkey + 5 AS VARCHAR), 9, '0')
    UNION ALL
    SELECT 'CUSTOMER#' || lpad(CAST(s_suppkey + 5 AS VARCHAR), 9, '0'), s_acctbal, NULL FROM supplier
    WHERE 'customer#' || lpad(CAST(s_suppkey + 5 AS VARCHAR), 9, '0') NOT IN (SELECT lower(c_name) FROM customer)
    """,
)
def merge_collated_keys(spark, sf):
    """Suppliers as changes to customers, under customer names in capitals; the target's spelling stays."""
    target = table(spark, sf, "customer").select("c_name", "c_acctbal", "c_mktsegment")
    number = F.lpad((F.col("s_suppkey") + 5).cast("string"), 9, "0")
    changes = table(spark, sf, "supplier").select(F.concat(F.lit("CUSTOMER#"), number).alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    return merge_upsert(target, changes, ["c_name"], collation="UTF8_LCASE")


@query(
    "latest_collated",
    """
    SELECT o_custkey, priority, o_orderkey FROM (
      SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS priority FROM orders)
    QUALIFY row_number() OVER (PARTITION BY o_custkey, lower(priority) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def latest_collated(spark, sf):
    """The newest order of each customer and priority, which is spelled in two ways."""
    priority = F.when(F.col("o_orderkey") % 2 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    orders = table(spark, sf, "orders").withColumn("priority", priority)
    newest = keep_latest(orders, ["o_custkey", "priority"], newest_first("o_orderdate", "o_orderkey"), "UTF8_LCASE")
    return newest.select("o_custkey", "priority", "o_orderkey")


@query(
    "state_commit",
    f"""
    WITH {CHANGES_SQL},
    state AS (
      SELECT l.* EXCLUDE (change_kind) FROM changes l
      UNION ALL
      SELECT e.* FROM earlier e WHERE NOT EXISTS (
        SELECT 1 FROM changes c WHERE c.l_orderkey = e.l_orderkey AND c.l_linenumber = e.l_linenumber))
    SELECT '{STREAM}' AS stream_id, 'erp' AS destination_id, {KEY_SQL} AS key_hash, {DATA_SQL} AS data_hash FROM state l
    """,
)
def state_commit(spark, sf):
    state = state_of(snapshot(spark, sf, EARLIER), STREAM, "erp")
    changes = line_changes(spark, sf).withColumns({"stream_id": F.lit(STREAM), "destination_id": F.lit("erp")})
    return commit(state, changes)


OLD_STREAM = stream_id("parties", "rh_empleado", ["id"])
NEW_STREAM = stream_id("parties", "erp_organizacion_empleado", ["id"])


def party_state(spark, sf):
    """Customers under the old stream for d0 to d2, suppliers under the new one for d0 and d1."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_nationkey") % 3).alias("at")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (F.col("s_nationkey") % 2).alias("at")
    )

    def state(df, stream):
        ids = [F.lit(stream).alias("stream_id"), F.concat(F.lit("d"), F.col("at").cast("string")).alias("destination_id")]
        hashes = [fingerprint(df, ["id"]).alias("key_hash"), fingerprint(df, ["id", "name"]).alias("data_hash")]
        return df.select(*ids, *hashes)

    return state(customers, OLD_STREAM).unionByName(state(suppliers, NEW_STREAM))


_PARTY_SQL = (
    "'d' || place AS destination_id, "
    + fingerprint_sql(id=("i", "CAST(id AS VARCHAR)")) + " AS key_hash, "
    + fingerprint_sql(id=("i", "CAST(id AS VARCHAR)"), name=("s", "name")) + " AS data_hash"
)


@query(
    "state_migrate",
    f"""
    SELECT '{NEW_STREAM}' AS stream_id, {_PARTY_SQL}
    FROM (SELECT c_custkey AS id, c_name AS name, c_nationkey % 3 AS place FROM customer)
    WHERE place NOT IN (SELECT s_nationkey % 2 FROM supplier)
    UNION ALL
    SELECT '{NEW_STREAM}', {_PARTY_SQL} FROM (SELECT s_suppkey AS id, s_name AS name, s_nationkey % 2 AS place FROM supplier)
    """,
)
def state_migrate(spark, sf):
    moved = migrate(party_state(spark, sf), OLD_STREAM, NEW_STREAM)
    return migrate(moved, OLD_STREAM, NEW_STREAM)


@query(
    "state_summary",
    f"""
    SELECT '{OLD_STREAM}' AS stream_id, 'd' || c_nationkey % 3 AS destination_id, count(*) AS tracked FROM customer GROUP BY ALL
    UNION ALL
    SELECT '{NEW_STREAM}', 'd' || s_nationkey % 2, count(*) FROM supplier GROUP BY ALL
    """,
)
def state_summary_query(spark, sf):
    return state_summary(party_state(spark, sf))


def two_cycles(spark, sf, mode: str, periods=(EARLIER, LATER), **options):
    """Deliver the earlier and then the later snapshot through the whole sync."""
    root = f"{shared_folder(spark)}/sync-{uuid.uuid4().hex}"
    workspace = Workspace(spark, f"{root}/workspace")
    destination = Destination("erp", f"{root}/erp", mode=mode)
    for period in periods:
        job = SyncJob("lines", lambda s, p=period: snapshot(s, sf, p), "erp_lines", LINE_KEYS, decimals=DECIMALS, **options)
        metrics = run_cycle(workspace, [job], [destination])
        if any(m["errors"] for m in metrics):
            raise RuntimeError([r.reason for r in workspace.failures.failures().collect()])
    return workspace, f"{root}/erp/erp_lines"


def _line_schema(spark, sf) -> T.StructType:
    return table(spark, sf, "lineitem").select(*COLUMNS).schema


@query(
    "sync_target",
    f"""
    WITH {CHANGES_SQL}
    SELECT * EXCLUDE (change_kind) FROM changes
    UNION ALL
    SELECT e.* FROM earlier e WHERE NOT EXISTS (
      SELECT 1 FROM changes c WHERE c.l_orderkey = e.l_orderkey AND c.l_linenumber = e.l_linenumber)
    """,
)
def sync_target(spark, sf):
    _, path = two_cycles(spark, sf, "upsert")
    return UpsertTable(spark, path, _line_schema(spark, sf), LINE_KEYS).read()


@query("sync_digest_target", SQL["sync_target"])
def sync_digest_target(spark, sf):
    """The cycle with digests by key range; the last poll finds nothing changed and reads no state."""
    workspace, path = two_cycles(spark, sf, "upsert", (EARLIER, LATER, LATER), digests=True)
    idle = workspace.run_metrics().groupBy("cycle_id").agg(F.sum("changes").alias("changes")).where("changes = 0").count()
    if idle != 1:
        raise RuntimeError(f"{idle} of three polls were idle")
    return UpsertTable(spark, path, _line_schema(spark, sf), LINE_KEYS).read()


@query(
    "history_append",
    f"""
    WITH {CHANGES_SQL}
    SELECT *, 'first' AS delivery FROM earlier UNION ALL SELECT * EXCLUDE (change_kind), 'second' FROM changes
    """,
)
def history_append(spark, sf):
    workspace, path = two_cycles(spark, sf, "history")
    rows = read_history(spark, path, _line_schema(spark, sf))
    # batch ids are hashes; the first delivery is the one made from an empty state
    first = F.col("batch_id") == batch_id(STREAM, "erp", 0, workspace.lineage)
    return rows.withColumn("delivery", F.when(first, "first").otherwise("second")).drop("batch_id")


@query(
    "sync_reserved_names",
    """
    SELECT c_custkey AS key_hash, c_name AS data_hash, c_nationkey AS destination_id, c_mktsegment AS change_kind
    FROM customer
    """,
)
def sync_reserved_names(spark, sf):
    """Two cycles over a source whose columns are called like the cycle's own; the second changes half of the rows."""
    root = f"{shared_folder(spark)}/sync-{uuid.uuid4().hex}"
    workspace = Workspace(spark, f"{root}/workspace")
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key_hash"), F.col("c_name").alias("data_hash"),
        F.col("c_nationkey").alias("destination_id"), F.col("c_mktsegment").alias("change_kind"),
    )
    before = rows.withColumn("data_hash", F.when(F.col("key_hash") % 2 == 0, F.col("data_hash")))
    for frame in (before, rows):
        job = SyncJob("customers", lambda _, df=frame: df, "customers", ["KEY_HASH"])
        metrics = run_cycle(workspace, [job], [Destination("erp", f"{root}/erp")])
        if any(m["errors"] for m in metrics):
            raise RuntimeError([r.reason for r in workspace.failures.failures().collect()])
    return UpsertTable(spark, f"{root}/erp/customers", rows.schema, ["key_hash"]).read()


def _stream(spark, sf, name: str):
    """The files of a table as a stream; the pattern fits a file and a folder of files."""
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parquet*")


@query("stream_sync_target", _snapshot_sql("l_shipdate >= '1900-01-01'"))
def stream_sync_target(spark, sf):
    """Line items arriving as a stream; the target ends with the latest row of each."""
    root = f"{shared_folder(spark)}/sync-{uuid.uuid4().hex}"
    workspace = Workspace(spark, f"{root}/workspace")
    lines = _stream(spark, sf, "lineitem").select(*COLUMNS, F.struct(*LINE_ORDER).alias("taken"))
    job = SyncJob("lines", "arrives as a stream", "erp_lines", LINE_KEYS, decimals=DECIMALS)
    to = [Destination("erp", f"{root}/erp")]
    stream_sync(lines, workspace, job, to, "taken", f"{root}/checkpoint", poll=None).awaitTermination()
    return UpsertTable(spark, f"{root}/erp/erp_lines", _line_schema(spark, sf), LINE_KEYS).read()


@query(
    "stream_history_versions",
    """
    SELECT user_id, event_type FROM (
      SELECT user_id, event_type, event_id, lag(event_type) OVER line AS before, row_number() OVER line AS place
      FROM events WINDOW line AS (PARTITION BY user_id ORDER BY event_id))
    WHERE place = 1 OR event_type IS DISTINCT FROM before
    """,
)
def stream_history_versions(spark, sf):
    """Every event is a snapshot of its user's last action: history gets each change of it, in one pass."""
    root = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    actions = _stream(spark, sf, "events").select("user_id", "event_type", "event_id")
    job = SyncJob("actions", "arrives as a stream", "actions", ["user_id"])
    to = [Destination("log", f"{root}/log", mode="history"), Destination("erp", f"{root}/erp")]
    workspace = Workspace(spark, f"{root}/workspace")
    stream_sync(actions, workspace, job, to, "event_id", f"{root}/checkpoint", poll=None).awaitTermination()
    schema = table(spark, sf, "events").select("user_id", "event_type").schema
    return read_history(spark, f"{root}/log/actions", schema).drop("batch_id")


@query(
    "stream_failure_latch",
    """
    WITH counted AS (
      SELECT CAST(user_id AS VARCHAR) AS scope, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
               RANGE BETWEEN INTERVAL 72 HOURS PRECEDING AND CURRENT ROW) AS in_window
      FROM events WHERE event_type = 'error')
    SELECT scope, min(ts) AS tripped_at FROM counted WHERE in_window >= 3 GROUP BY scope
    """,
)
def stream_failure_latch(spark, sf):
    """Errors arriving as a stream of failures, one scope for each user."""
    root = f"{shared_folder(spark)}/failures-{uuid.uuid4().hex}"
    log = FailureLog(spark, f"{root}/log", hours=72, threshold=3)
    errors = _stream(spark, sf, "events").where("event_type = 'error'")
    failures = errors.select(
        F.col("user_id").cast("string").alias("scope"), F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.lit("events").alias("stream"), F.lit(None).cast("string").alias("destination"), F.col("event_type").alias("reason"),
    )
    failure_state(failures, log, f"{root}/checkpoint", poll=None).awaitTermination()
    return log.latches().select("scope", "tripped_at")


@query(
    "stream_failure_counts",
    """
    WITH seconds AS (SELECT user_id, date_trunc('second', ts) AS second, count(*) AS failures
                     FROM events WHERE event_type = 'error' GROUP BY ALL)
    SELECT *, in_window >= 5 AS tripped FROM (
      SELECT user_id, CAST(second AS TIMESTAMP) AS second, failures,
             CAST(sum(failures) OVER (PARTITION BY user_id ORDER BY second
                  RANGE BETWEEN INTERVAL 72 HOURS PRECEDING AND CURRENT ROW) AS BIGINT) AS in_window
      FROM seconds)
    """,
)
def stream_failure_counts(spark, sf):
    """Errors of each user arriving as a stream, counted by second in streaming state."""
    errors = _stream(spark, sf, "events").where("event_type = 'error'").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    scope = T.StructType([T.StructField("user_id", T.LongType())])
    counted = FailureCounts(spark, f"{shared_folder(spark)}/counts-{uuid.uuid4().hex}", scope, hours=72, threshold=5)
    counted.watch(errors, poll=None).awaitTermination()
    return counted.bursts().withColumn("second", F.col("second").cast("timestamp_ntz"))


@query("stream_polled_sync", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def stream_polled_sync(spark, sf):
    """Customers polled in four key ranges and synced from the stream of polls; the table folder stands in for a database."""
    root = f"{shared_folder(spark)}/polled-{uuid.uuid4().hex}"
    customers = table(spark, sf, "customer")
    edges = [int(e) for e in customers.approxQuantile("c_custkey", [0.25, 0.5, 0.75], 0.01)]
    rows = folder_ranges(f"{sf}/customer.parquet", "c_custkey")
    stream = polled_stream(spark, "customers_polled", customers.schema, rows, lambda: sorted(set(edges)))
    job = SyncJob("customers", "polled", "customers", ["c_custkey"])
    workspace = Workspace(spark, f"{root}/workspace")
    stream_sync(stream, workspace, job, [Destination("erp", f"{root}/erp")], "polled", f"{root}/checkpoint", poll=None).awaitTermination()
    return UpsertTable(spark, f"{root}/erp/customers", customers.schema, ["c_custkey"]).read()


@query("batched_write", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def batched_write(spark, sf):
    """Nations written in batches of four rows, each applied whole; the folder stands in for a database."""
    path = f"{shared_folder(spark).removeprefix('file:')}/batched-{uuid.uuid4().hex}"
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    write_batches(nations, FolderSink(path), batch_size=4)
    return spark.read.schema(nations.schema).parquet(f"{path}/*.parquet")


@query(
    "depth_ranges",
    """
    SELECT count(*) AS rows, count(*) AS in_one_range, true AS balanced FROM lineitem
    """,
)
def depth_ranges_query(spark, sf):
    """Line items by the square of a key, with one key for a third of them: rows, rows in exactly one of 16 ranges, and whether no range but that of a heavy key is larger than twice the mean."""
    key = F.when(F.col("l_linenumber") % 3 == 0, -1).otherwise(F.col("l_orderkey") * F.col("l_orderkey"))
    lines = table(spark, sf, "lineitem").select(key.alias("key"))
    ranges = depth_ranges(lines, "key", 16)
    inside = [r.column(F.col("key")).cast("long") for r in ranges]
    hits = sum(inside, F.lit(0))
    largest = F.greatest(*[F.sum(x) for x, r in zip(inside, ranges) if not r.single])
    return lines.agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(hits == 1, 1)).alias("in_one_range"),
        (largest * 16 <= 2 * F.count(F.lit(1))).alias("balanced"),
    )


@query(
    "united_distincts",
    """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, true AS within FROM lineitem GROUP BY l_suppkey
    """,
)
def united_distincts_query(spark, sf):
    """Different parts of each supplier: exact, and whether the estimate from the united sketches of the years is within 6 % (or one)."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year"), "l_partkey")
    estimate = united_distincts(distinct_sketches(lines, ["l_suppkey", "year"], "l_partkey"), ["l_suppkey"])
    exact = lines.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"))
    off = F.abs(F.col("distinct_values") - F.col("parts"))
    return exact.join(estimate, "l_suppkey").select("l_suppkey", "parts", (off <= F.greatest(F.lit(1.0), 0.06 * F.col("parts"))).alias("within"))


@query(
    "script_job",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_totalprice >= 100000 AND o_orderpriority <> '5-LOW'
    """,
)
def script_job(spark, sf):
    """An extract written as a script, with a declared variable and bound parameters."""
    view = f"orders_{uuid.uuid4().hex}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    text = f"""
    BEGIN
      DECLARE least DOUBLE DEFAULT :thousands;
      SET least = least * 1000;
      SELECT o_orderkey, o_custkey, o_totalprice FROM {view} WHERE o_totalprice >= least AND o_orderpriority <> :left_out;
    END;
    """
    job = SyncJob("orders", text, "orders", ["o_orderkey"], parameters={"thousands": 100, "left_out": "5-LOW"})
    return job.frame(spark)
