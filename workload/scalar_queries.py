"""Cleaning and composing expressions over whole tables.

The tables hold no NULLs, blanks or over-long text, so the raw values are first
roughened from other columns, identically in Spark and in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.clean import (
    clean_text,
    coalesce_ts,
    compose_code,
    first_valid,
    full_name,
    is_guid,
    iso_date,
    money,
    normalize_guid,
    pad_digits,
)
from tidemark.functions.fingerprint import fingerprint
from tidemark.functions.names import CURRENT_NAMES, current_name, legacy_name
from workload.registry import fingerprint_sql, query, table


@query(
    "clean_text",
    """
    WITH raw AS (
      SELECT p_partkey, p_type, p_size,
             CASE WHEN p_size % 11 = 0 THEN repeat(' ', p_size)
                  ELSE repeat(' ', p_size % 7) || p_name || repeat(' ', p_size % 3) END AS name
      FROM part)
    SELECT p_partkey,
           left(nullif(trim(substring(name, 1, 9)), ''), 6) AS short_name,
           nullif(trim(substring(name, 1, 200)), '') AS name,
           upper(nullif(trim(substring(lower(p_type), 1, 50)), '')) AS status
    FROM raw
    """,
)
def clean_text_query(spark, sf):
    padded = F.concat(F.expr("repeat(' ', p_size % 7)"), "p_name", F.expr("repeat(' ', p_size % 3)"))
    name = F.when(F.col("p_size") % 11 == 0, F.expr("repeat(' ', p_size)")).otherwise(padded)
    return table(spark, sf, "part").withColumn("name", name).select(
        "p_partkey",
        clean_text("name", 9, 6).alias("short_name"),
        clean_text("name", 200).alias("name"),
        clean_text(F.lower("p_type"), 50, upper=True).alias("status"),
    )


GUID_SQL = """substring(md5(c_name), 1, 8) || '-' || substring(md5(c_name), 9, 4) || '-' ||
              substring(md5(c_name), 13, 4) || '-' || substring(md5(c_name), 17, 4) || '-' ||
              substring(md5(c_name), 21, 12)"""


@query(
    "normalize_guid",
    f"""
    WITH raw AS (
      SELECT c_custkey,
             CASE c_nationkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '{{' || {GUID_SQL} || '}}'
                  WHEN 2 THEN ' ' || {GUID_SQL} || '  ' ELSE {GUID_SQL} END AS guid
      FROM customer)
    SELECT c_custkey,
           upper(replace(replace(trim(substring(guid, 1, 40)), '{{', ''), '}}', '')) AS id,
           length(upper(replace(replace(trim(substring(guid, 1, 40)), '{{', ''), '}}', ''))) = 36 AS usable
    FROM raw
    """,
)
def normalize_guid_query(spark, sf):
    guid = F.expr(GUID_SQL)
    kind = F.col("c_nationkey") % 4
    raw = (
        F.when(kind == 0, "0")
        .when(kind == 1, F.concat(F.lit("{"), guid, F.lit("}")))
        .when(kind == 2, F.concat(F.lit(" "), guid, F.lit("  ")))
        .otherwise(guid)
    )
    cleaned = table(spark, sf, "customer").select("c_custkey", normalize_guid(raw).alias("id"))
    return cleaned.withColumn("usable", is_guid("id"))


@query(
    "compose_code",
    """
    SELECT o_orderkey,
           left(upper(nullif(lower(o_orderpriority), '5-low') || strftime(o_orderdate, '%y%m%d')
                      || nullif(o_orderstatus, 'P')), 20) AS code,
           left(upper(o_orderstatus || strftime(o_orderdate, '%y%m%d') || CAST(o_custkey AS VARCHAR)), 9) AS short_code
    FROM orders
    """,
)
def compose_code_query(spark, sf):
    prefix = F.nullif(F.lower("o_orderpriority"), F.lit("5-low"))
    suffix = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        compose_code(prefix, "o_orderdate", suffix, 20).alias("code"),
        compose_code("o_orderstatus", "o_orderdate", F.col("o_custkey").cast("string"), 9).alias("short_code"),
    )


@query(
    "full_name",
    """
    SELECT p_partkey,
           left(nullif(trim(concat_ws(' ', CASE WHEN p_size % 2 = 0 THEN p_name END,
                                      CASE WHEN p_size % 3 = 0 THEN p_brand END,
                                      CASE WHEN p_size % 5 = 0 THEN p_type END)), ''), 200) AS name
    FROM part
    """,
)
def full_name_query(spark, sf):
    part = lambda n, c: F.when(F.col("p_size") % n == 0, F.col(c))
    return table(spark, sf, "part").select(
        "p_partkey", full_name(part(2, "p_name"), part(3, "p_brand"), part(5, "p_type")).alias("name")
    )


@query(
    "pad_digits",
    """
    WITH raw AS (
      SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_brand WHEN 1 THEN CAST(p_partkey AS VARCHAR)
                        WHEN 2 THEN CAST(p_partkey * 7919 AS VARCHAR) END AS postal
      FROM part)
    SELECT p_partkey,
           CASE WHEN regexp_full_match(postal, '[0-9]+') AND length(postal) <= 5 THEN lpad(postal, 5, '0')
                ELSE left(postal, 10) END AS postal
    FROM raw
    """,
)
def pad_digits_query(spark, sf):
    kind = F.col("p_size") % 4
    postal = (
        F.when(kind == 0, F.col("p_brand"))
        .when(kind == 1, F.col("p_partkey").cast("string"))
        .when(kind == 2, (F.col("p_partkey") * 7919).cast("string"))
    )
    return table(spark, sf, "part").select("p_partkey", pad_digits(postal).alias("postal"))


@query(
    "first_valid",
    """
    WITH raw AS (
      SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '0' ELSE '  ' END AS a,
             CASE WHEN p_size % 3 = 0 THEN ' 0 ' ELSE ' ' || p_name END AS b,
             CASE WHEN p_size % 9 = 0 THEN '' ELSE p_brand END AS c
      FROM part)
    SELECT p_partkey,
           left(coalesce(nullif(nullif(trim(substring(a, 1, 30)), ''), '0'),
                         nullif(nullif(trim(substring(b, 1, 30)), ''), '0'),
                         nullif(nullif(trim(substring(c, 1, 30)), ''), '0')), 30) AS phone
    FROM raw
    """,
)
def first_valid_query(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        first_valid(
            F.when(size % 2 == 0, "0").otherwise("  "),
            F.when(size % 3 == 0, " 0 ").otherwise(F.concat(F.lit(" "), "p_name")),
            F.when(size % 9 == 0, "").otherwise(F.col("p_brand")),
        ).alias("phone"),
    )


@query(
    "iso_date",
    """
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
           CAST(CAST(CASE WHEN event_type <> 'view' THEN ts END AS DATE) AS VARCHAR) AS day_unless_view
    FROM events
    """,
)
def iso_date_query(spark, sf):
    unless_view = F.when(F.col("event_type") != "view", F.col("ts"))
    return table(spark, sf, "events").select(
        "event_id", iso_date("ts").alias("day"), iso_date(unless_view).alias("day_unless_view")
    )


@query(
    "money_cast",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
           CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DECIMAL(12,1)) AS rounded,
           TRY_CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DECIMAL(6,2)) AS small
    FROM lineitem
    """,
)
def money_cast_query(spark, sf):
    exact = money("l_extendedprice", 18, 4)
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        money("l_extendedprice").alias("price"),
        money(exact, 12, 1).alias("rounded"),
        money(exact, 6, 2, strict=False).alias("small"),
    )


@query(
    "coalesce_updated",
    """
    SELECT o_orderkey,
           coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END,
                    CASE WHEN o_orderstatus = 'O' THEN o_orderdate - INTERVAL 30 DAY END,
                    TIMESTAMP '1900-01-01 00:00:00') AS updated_at
    FROM orders
    """,
)
def coalesce_updated_query(spark, sf):
    finished = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    opened = F.when(F.col("o_orderstatus") == "O", F.expr("o_orderdate - INTERVAL '30' DAY"))
    return table(spark, sf, "orders").select("o_orderkey", coalesce_ts(finished, opened).alias("updated_at"))


@query(
    "fingerprint",
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, "
    + fingerprint_sql(l_orderkey=("i", "CAST(l_orderkey AS VARCHAR)"), l_linenumber=("i", "CAST(l_linenumber AS VARCHAR)"))
    + " AS key_hash, "
    + fingerprint_sql(
        **{c: ("i", f"CAST({c} AS VARCHAR)") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")},
        **{c: ("n", f"CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)")
           for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
        l_returnflag=("s", "nullif(l_returnflag, 'N')"),
        l_linestatus=("s", "l_linestatus"),
        l_shipdate=("t", "CAST(l_shipdate AS VARCHAR)"),
    )
    + " AS data_hash FROM lineitem",
)
def fingerprint_query(spark, sf):
    lines = table(spark, sf, "lineitem")
    lines = lines.withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    decimals = dict.fromkeys(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), (12, 2))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
        fingerprint(lines, ["l_orderkey", "l_linenumber"]).alias("key_hash"),
        fingerprint(lines, None, decimals).alias("data_hash"),
    )


@query(
    "fingerprint_documents",
    "SELECT doc_id, "
    + fingerprint_sql(
        doc_id=("i", "CAST(doc_id AS VARCHAR)"),
        text=("s", '"text"'),
        lang=("s", "lang"),
        source=("s", "source"),
        n_chars=("i", "CAST(n_chars AS VARCHAR)"),
    )
    + " AS data_hash FROM documents",
)
def fingerprint_documents_query(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", fingerprint(documents).alias("data_hash"))


@query(
    "fingerprint_events",
    "SELECT event_id, "
    + fingerprint_sql(
        event_id=("i", "CAST(event_id AS VARCHAR)"),
        ts=("t", "CAST(ts AS VARCHAR)"),
        user_id=("i", "CAST(user_id AS VARCHAR)"),
        event_type=("s", "event_type"),
        value=("n", "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)"),
        props=("s", "props"),
    )
    + " AS data_hash FROM events",
)
def fingerprint_events_query(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", fingerprint(events, None, {"value": (18, 2)}).alias("data_hash"))


_NAMES = [*CURRENT_NAMES, "clientes", "erp_organizacion_empresa", "casl_rol", "erp_rh_turno"]
_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in _NAMES) + "]"
_RENAMES_SQL = ", ".join(f"('{old}', '{new}', {i})" for i, (old, new) in enumerate(CURRENT_NAMES.items()))


@query(
    "rename_map",
    f"""
    WITH renames(old_name, new_name, place) AS (VALUES {_RENAMES_SQL}),
    back AS (SELECT new_name, max_by(old_name, place) AS old_name FROM renames GROUP BY new_name),
    named AS (SELECT c_custkey, c_nationkey % 4 AS kind, {_NAMES_SQL}[c_custkey % {len(_NAMES)} + 1] AS name FROM customer),
    raw AS (
      SELECT c_custkey, kind, name,
             CASE kind WHEN 0 THEN name WHEN 1 THEN 'db.' || upper(name)
                       WHEN 2 THEN '[db] . [' || name || ']' ELSE ' `' || name || '` ' END AS table_name,
             CASE kind WHEN 1 THEN 'db.' WHEN 2 THEN 'db.' ELSE '' END AS prefix,
             CASE kind WHEN 1 THEN upper(name) ELSE name END AS spelled
      FROM named)
    SELECT c_custkey, table_name, prefix || coalesce(r.new_name, spelled) AS current_name,
           prefix || b.old_name AS legacy_name
    FROM raw LEFT JOIN renames r ON r.old_name = raw.name LEFT JOIN back b ON b.new_name = raw.name
    """,
)
def rename_map_query(spark, sf):
    names = F.array(*[F.lit(n) for n in _NAMES])
    named = table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_nationkey") % 4).alias("kind"),
        F.get(names, (F.col("c_custkey") % len(_NAMES)).cast("int")).alias("name"),
    )
    kind, name = F.col("kind"), F.col("name")
    spelled = (
        F.when(kind == 0, name)
        .when(kind == 1, F.concat(F.lit("db."), F.upper(name)))
        .when(kind == 2, F.concat(F.lit("[db] . ["), name, F.lit("]")))
        .otherwise(F.concat(F.lit(" `"), name, F.lit("` ")))
    )
    return named.select("c_custkey", spelled.alias("table_name")).withColumns(
        {"current_name": current_name(F.col("table_name")), "legacy_name": legacy_name(F.col("table_name"))}
    )
