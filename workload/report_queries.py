"""Scans, lookups, checks and reports over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.clean import clean_text, money
from tidemark.model import SyncJob
from tidemark.operators.audit import cycle_totals, retain
from tidemark.operators.conform import (
    among,
    guard_source,
    having_parent,
    lookup,
    orphans,
    project,
    union_origins,
    with_parent,
)
from tidemark.operators.failures import failure_burst, failure_latch
from tidemark.operators.latest import keep_latest, newest_first
from tidemark.operators.merge import backfill
from tidemark.operators.quality import dup_keys, null_keys
from tidemark.operators.reports import (
    count_by_parent,
    duplicate_keys,
    orphan_counts,
    shared_values,
    unexpected_parents,
)
from workload.registry import query, table


@query(
    "scan_filtered",
    """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_orderdate AS changed_at
    FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice >= 100000
    """,
)
def scan_filtered(spark, sf):
    def extract(session):
        return (
            table(session, sf, "orders")
            .where((F.col("o_orderstatus") != "F") & (F.col("o_totalprice") >= 100000))
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_orderdate").alias("changed_at"),
            )
        )

    return SyncJob("open_orders", extract, "orders_copy", ["order_id"]).frame(spark)


LATEST_LINES_SQL = """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) = 1
"""
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


@query("keep_latest", LATEST_LINES_SQL)
def keep_latest_query(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_orderkey is not null and l_linenumber is not null")
    return keep_latest(lines, LINE_KEYS, newest_first(*LINE_ORDER))


@query(
    "latest_then_required",
    """
    WITH latest AS (
      SELECT o_custkey, o_orderkey, o_orderdate, nullif(o_orderstatus, 'P') AS status FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1)
    SELECT * FROM latest WHERE status IS NOT NULL
    """,
)
def latest_then_required(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return keep_latest(orders, ["o_custkey"], newest_first("o_orderdate", "o_orderkey")).where("status is not null")


@query(
    "lookup_join",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name AS part, s_name AS supplier
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
    """,
)
def lookup_join(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named = lookup(lines, table(spark, sf, "part"), {"l_partkey": "p_partkey"}, {"p_name": "part"})
    return lookup(named, table(spark, sf, "supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "supplier"})


@query(
    "parent_columns",
    """
    SELECT o_orderkey, o_custkey, c_name AS customer
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    """,
)
def parent_columns(spark, sf):
    orders = among(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    named = with_parent(orders, table(spark, sf, "customer"), "o_custkey", "c_custkey", {"c_name": "customer"})
    return named.select("o_orderkey", "o_custkey", "customer")


@query(
    "conform_customer",
    """
    SELECT c_custkey AS customer_id, 'OWNER-1' AS owner_id, 'ACTIVE' AS status,
           nullif(trim(substring(c_name, 1, 40)), '') AS name,
           upper(nullif(trim(substring(c_mktsegment, 1, 20)), '')) AS segment,
           n_name AS country, r_name AS region, CAST(c_acctbal AS DECIMAL(12,2)) AS balance
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    """,
)
def conform_customer(spark, sf):
    rows = lookup(table(spark, sf, "customer"), table(spark, sf, "nation"), {"c_nationkey": "n_nationkey"},
                  {"n_name": "country", "n_regionkey": "region_id"})
    rows = lookup(rows, table(spark, sf, "region"), {"region_id": "r_regionkey"}, {"r_name": "region"})
    return project(
        rows,
        {
            "customer_id": "c_custkey",
            "owner_id": F.lit("OWNER-1"),
            "status": F.lit("ACTIVE"),
            "name": clean_text("c_name", 40),
            "segment": clean_text("c_mktsegment", 20, upper=True),
            "country": "country",
            "region": "region",
            "balance": money("c_acctbal"),
        },
    )


@query(
    "origin_union",
    """
    SELECT c_custkey AS party_id, c_name AS name, 'Customers' AS origin FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'Suppliers' FROM supplier
    """,
)
def origin_union(spark, sf):
    jobs = {
        "Customers": table(spark, sf, "customer").select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name")),
        "Suppliers": table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name")),
    }
    return union_origins(jobs, "origin", auto_id="id")


@query(
    "source_guard",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE EXISTS (SELECT 1 FROM nation WHERE n_name = 'NATION_7')
      AND NOT EXISTS (SELECT 1 FROM nation WHERE n_name = 'NATION_X')
    """,
)
def source_guard(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    nation = table(spark, sf, "nation")
    refused = guard_source(orders, nation, "n_name", "NATION_X")
    return guard_source(orders, nation, "n_name", "NATION_7").unionByName(refused)


@query(
    "report_count_by_parent",
    """
    SELECT c_nationkey, n_name AS parent_name, count(*) AS total
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY c_nationkey, n_name ORDER BY 2, 1
    """,
)
def report_count_by_parent(spark, sf):
    report = count_by_parent(table(spark, sf, "customer"), table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name")
    return report.orderBy("parent_name", "c_nationkey")


@query(
    "report_unexpected",
    """
    SELECT c_nationkey, count(*) AS total FROM customer
    WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (1, 2, 3) GROUP BY c_nationkey
    """,
)
def report_unexpected(spark, sf):
    return unexpected_parents(table(spark, sf, "customer"), "c_nationkey", [1, 2, 3])


# Parts name the suppliers that delivered them; a fifth of the references is
# empty and the others reach beyond the supplier table.
REFERENCES_SQL = """(SELECT p_partkey, p_size, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_partkey % 1500 END AS supplier_id FROM part)"""


def _references(spark, sf):
    supplier = F.when(F.col("p_size") % 5 != 0, F.col("p_partkey") % 1500)
    return table(spark, sf, "part").select("p_partkey", "p_size", supplier.alias("supplier_id"))


@query(
    "report_orphans",
    f"""
    SELECT supplier_id, count(*) AS total FROM {REFERENCES_SQL} LEFT JOIN supplier ON s_suppkey = supplier_id
    WHERE supplier_id IS NULL OR s_suppkey IS NULL GROUP BY supplier_id
    """,
)
def report_orphans(spark, sf):
    return orphan_counts(_references(spark, sf), table(spark, sf, "supplier"), "supplier_id", "s_suppkey")


@query(
    "orphan_rows",
    f"""
    SELECT p_partkey, p_size, supplier_id FROM {REFERENCES_SQL} LEFT JOIN supplier ON s_suppkey = supplier_id
    WHERE s_suppkey IS NULL
    """,
)
def orphan_rows(spark, sf):
    return orphans(_references(spark, sf), table(spark, sf, "supplier"), "supplier_id", "s_suppkey")


@query(
    "rows_with_parent",
    f"""
    SELECT p_partkey, p_size, supplier_id FROM {REFERENCES_SQL}
    WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = supplier_id)
    """,
)
def rows_with_parent(spark, sf):
    return having_parent(_references(spark, sf), table(spark, sf, "supplier"), "supplier_id", "s_suppkey")


@query(
    "report_duplicates",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS repetitions FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2
    """,
)
def report_duplicates(spark, sf):
    report = duplicate_keys(table(spark, sf, "lineitem"), LINE_KEYS)
    return report.orderBy(F.desc("repetitions"), *LINE_KEYS)


@query(
    "report_shared",
    """
    SELECT l_partkey, count(DISTINCT l_suppkey) AS parents FROM lineitem
    WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
    GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1 ORDER BY 2 DESC, 1
    """,
)
def report_shared(spark, sf):
    return shared_values(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey").orderBy(F.desc("parents"), "l_partkey")


@query(
    "check_null_keys",
    f"SELECT p_partkey, p_size, supplier_id FROM {REFERENCES_SQL} WHERE p_partkey IS NULL OR supplier_id IS NULL",
)
def check_null_keys(spark, sf):
    return null_keys(_references(spark, sf), ["p_partkey", "supplier_id"])


@query(
    "check_dup_keys",
    f"""
    SELECT supplier_id, p_size, count(*) AS repetitions FROM {REFERENCES_SQL}
    GROUP BY supplier_id, p_size HAVING count(*) > 1
    """,
)
def check_dup_keys(spark, sf):
    return dup_keys(_references(spark, sf), ["supplier_id", "p_size"])


@query(
    "backfill_parent",
    """
    SELECT c_custkey, c_mktsegment,
           CASE WHEN c_mktsegment = 'MACHINERY' AND EXISTS (SELECT 1 FROM nation WHERE n_nationkey = 7)
                     AND (c_nationkey IS NULL OR c_nationkey <> 7) THEN 7 ELSE c_nationkey END AS c_nationkey
    FROM customer
    """,
)
def backfill_parent(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation, chosen = table(spark, sf, "nation"), F.col("c_mktsegment") == "MACHINERY"
    filled = backfill(customers, nation, "c_nationkey", "n_nationkey", 7, chosen)
    # nation 99 does not exist, so the second backfill changes nothing
    return backfill(filled, nation, "c_nationkey", "n_nationkey", 99, F.lit(True))


@query(
    "failure_burst",
    """
    WITH counted AS (
      SELECT user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
               RANGE BETWEEN INTERVAL 72 HOURS PRECEDING AND CURRENT ROW) AS in_window
      FROM events WHERE event_type = 'error')
    SELECT user_id, ts, count(*) AS failures, max(in_window) AS in_window, max(in_window) >= 5 AS tripped
    FROM counted GROUP BY user_id, ts
    """,
)
def failure_burst_query(spark, sf):
    errors = table(spark, sf, "events").where("event_type = 'error'")
    return failure_burst(errors, ["user_id"], "ts", hours=72, threshold=5)


@query(
    "failure_burst_global",
    """
    WITH counted AS (
      SELECT ts, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 3 HOURS PRECEDING AND CURRENT ROW) AS in_window
      FROM events)
    SELECT 'global' AS scope, ts, count(*) AS failures, max(in_window) AS in_window, max(in_window) >= 50 AS tripped
    FROM counted GROUP BY ts
    """,
)
def failure_burst_global(spark, sf):
    everything = table(spark, sf, "events").select(F.lit("global").alias("scope"), "ts")
    return failure_burst(everything, ["scope"], "ts", hours=3, threshold=50)


@query(
    "failure_latch",
    """
    WITH failed AS (SELECT user_id, ts FROM events WHERE event_type = 'error'),
    cleared AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'signup'),
    epochs AS (
      SELECT f.user_id, f.ts, max(c.ts) AS cleared_at
      FROM failed f LEFT JOIN cleared c ON c.user_id = f.user_id AND c.ts < f.ts GROUP BY f.user_id, f.ts),
    repeated AS (SELECT e.* FROM failed f JOIN epochs e ON e.user_id = f.user_id AND e.ts = f.ts),
    counted AS (
      SELECT *, count(*) OVER (PARTITION BY user_id, cleared_at ORDER BY ts
                  RANGE BETWEEN INTERVAL 72 HOURS PRECEDING AND CURRENT ROW) AS in_window
      FROM repeated)
    SELECT user_id, cleared_at, min(ts) AS tripped_at FROM counted WHERE in_window >= 3 GROUP BY user_id, cleared_at
    """,
)
def failure_latch_query(spark, sf):
    events = table(spark, sf, "events")
    errors, clears = events.where("event_type = 'error'"), events.where("event_type = 'signup'")
    return failure_latch(errors, clears, ["user_id"], "ts", hours=72, threshold=3)


RUN_METRICS_SQL = """(
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS cycle_id, 'job-' || user_id % 4 AS job,
           CASE WHEN event_type = 'signup' AND user_id % 4 = 3 AND value < 3 THEN NULL ELSE event_type END AS destination,
           1000 + user_id % 4 AS rows_read, event_id % 7 AS changes,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS errors
    FROM events)"""


@query(
    "cycle_totals",
    f"""
    WITH per_job AS (
      SELECT cycle_id, job, max(rows_read) AS rows_read, sum(changes) AS changes, sum(errors) AS errors,
             bool_or(destination IS NULL) AS broken
      FROM {RUN_METRICS_SQL} GROUP BY cycle_id, job)
    SELECT cycle_id, CAST(sum(rows_read) AS BIGINT) AS rows_read, CAST(sum(changes) AS BIGINT) AS changes,
           CAST(sum(errors) AS BIGINT) AS errors, count(*) FILTER (NOT broken) AS jobs_done
    FROM per_job GROUP BY cycle_id
    """,
)
def cycle_totals_query(spark, sf):
    user = F.col("user_id") % 4
    broken = (F.col("event_type") == "signup") & (user == 3) & (F.col("value") < 3)
    metrics = table(spark, sf, "events").select(
        F.col("ts").cast("date").cast("string").alias("cycle_id"),
        F.concat(F.lit("job-"), user.cast("string")).alias("job"),
        F.when(~broken, F.col("event_type")).alias("destination"),
        (1000 + user).alias("rows_read"),
        (F.col("event_id") % 7).alias("changes"),
        (F.col("event_type") == "error").cast("int").alias("errors"),
    )
    return cycle_totals(metrics)


@query(
    "audit_retention",
    """
    SELECT event_id, ts, CAST(ts AS DATE) AS event_date, event_type AS event
    FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 14
    """,
)
def audit_retention(spark, sf):
    flags = table(spark, sf, "events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("event_date"), F.col("event_type").alias("event")
    )
    return retain(flags, F.lit("2024-01-30").cast("date"), days=14)
