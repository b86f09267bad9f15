"""The flagship extract and the two conformance plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.conform import lookup, project
from tidemark.operators.latest import keep_latest, newest_first
from tidemark.plans.companies import company_extract
from tidemark.plans.employees import employee_extract
from workload.registry import query, table
from workload.report_queries import LATEST_LINES_SQL, LINE_KEYS, LINE_ORDER


@query(
    "line_extract",
    f"""
    WITH latest AS ({LATEST_LINES_SQL})
    SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_orderstatus AS order_status, c_name AS customer,
           n_name AS country, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped_on
    FROM latest LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    """,
)
def line_extract(spark, sf):
    lines = keep_latest(table(spark, sf, "lineitem"), LINE_KEYS, newest_first(*LINE_ORDER))
    rows = lookup(lines, table(spark, sf, "orders"), {"l_orderkey": "o_orderkey"},
                  {"o_orderstatus": "order_status", "o_custkey": "customer_id"})
    rows = lookup(rows, table(spark, sf, "customer"), {"customer_id": "c_custkey"},
                  {"c_name": "customer", "c_nationkey": "nation_id"})
    rows = lookup(rows, table(spark, sf, "nation"), {"nation_id": "n_nationkey"}, {"n_name": "country"})
    return project(
        rows,
        {
            "order_id": "l_orderkey",
            "line_no": "l_linenumber",
            "order_status": "order_status",
            "customer": "customer",
            "country": "country",
            "price": F.col("l_extendedprice").cast("decimal(12,2)"),
            "shipped_on": F.col("l_shipdate").cast("date").cast("string"),
        },
    )


# The column names on the left, those of the payroll source.
# Raw companies and employees cast from the orders, in text that both engines read.
_HEX = "md5(CAST(o_custkey AS STRING))"
_GUID = (f"substring({_HEX}, 1, 8) || '-' || substring({_HEX}, 9, 4) || '-' || substring({_HEX}, 13, 4) || '-' || "
         f"substring({_HEX}, 17, 4) || '-' || substring({_HEX}, 21, 12)")
RAW_COMPANY = {
    "IDEmpresa": "o_orderkey",
    "GUIDEmpresa": f"CASE o_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '{{' || {_GUID} || '}}' WHEN 2 THEN ' ' || {_GUID} ELSE {_GUID} END",
    "NombreEmpresa": "CASE WHEN o_orderkey % 9 = 0 THEN '   ' ELSE '  Company ' || CAST(o_custkey AS STRING) END",
    "NombreCorto": "repeat(o_orderpriority, 12)",
    "NombreEmpresaFiscal": "repeat(' ', 30) || repeat(o_orderpriority, 40)",
    "RFC": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE lower(o_orderstatus) || 'ab' END",
    "Homoclave": "substring(md5(CAST(o_orderkey AS STRING)), 1, 3)",
    "FechaConstitucion": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END",
    "NombreRepresentante": "CASE WHEN o_orderkey % 2 = 0 THEN ' Ana ' END",
    "ApPaternoRepresentante": "CASE WHEN o_orderkey % 3 = 0 THEN 'Ruiz' ELSE ' ' END",
    "ApMaternoRepresentante": "CASE WHEN o_orderkey % 5 = 0 THEN 'Paz' END",
    "RegistroIMSS": "repeat('A', 60)",
    "RegistroInfonavit": "CAST(o_custkey AS STRING)",
    "RegistroFonacot": "''",
    "RegimenFiscal": "o_orderstatus",
    "Direccion": "repeat(o_orderpriority || ' ', 80)",
    "Localidad": "o_orderpriority",
    "CodigoPostal": "CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN 'A' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey * 7919 AS STRING) END",
    "Telefono1": "CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE '' END",
    "Telefono2": "CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE CAST(o_orderkey AS STRING) END",
    "Telefono3": "CAST(o_custkey AS STRING)",
    "TimeStamp": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END",
    "FechaInicioHistoria": "CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate END",
}


def _raw_sql(columns: dict[str, str]) -> str:
    return ", ".join(f'{text} AS "{name}"' for name, text in columns.items())


def _cut(column: str, size: int) -> str:
    return f"nullif(trim(substring(CAST({column} AS VARCHAR), 1, {size})), '')"


@query(
    "conform_company",
    f"""
    WITH raw AS (SELECT {_raw_sql(RAW_COMPANY)} FROM orders),
    base AS (SELECT *, upper(replace(replace(trim(substring(GUIDEmpresa, 1, 40)), '{{', ''), '}}', '')) AS id FROM raw),
    latest AS (
      SELECT * FROM base WHERE id <> '' AND length(id) = 36
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY "TimeStamp" DESC NULLS LAST, IDEmpresa DESC) = 1),
    mapped AS (
      SELECT id, {_cut("IDEmpresa", 50)} AS codigo, {_cut("NombreEmpresa", 200)} AS nombre,
             {_cut("NombreCorto", 100)} AS nombre_corto, left({_cut("NombreEmpresaFiscal", 255)}, 200) AS nombre_fiscal,
             left(upper({_cut("RFC", 10)} || strftime(FechaConstitucion, '%y%m%d') || {_cut("Homoclave", 10)}), 20) AS rfc,
             left(nullif(trim(concat_ws(' ', {_cut("NombreRepresentante", 80)}, {_cut("ApPaternoRepresentante", 80)},
                                        {_cut("ApMaternoRepresentante", 80)})), ''), 200) AS representante_legal,
             {_cut("RegistroIMSS", 50)} AS registro_patronal_imss, {_cut("RegistroInfonavit", 50)} AS registro_infonavit,
             {_cut("RegistroFonacot", 50)} AS registro_fonacot, {_cut("RegimenFiscal", 100)} AS regimen_fiscal,
             {_cut("Direccion", 500)} AS direccion, {_cut("Localidad", 150)} AS localidad,
             CASE WHEN regexp_full_match({_cut("CodigoPostal", 10)}, '[0-9]+') AND length({_cut("CodigoPostal", 10)}) <= 5
                  THEN lpad({_cut("CodigoPostal", 10)}, 5, '0') ELSE left({_cut("CodigoPostal", 10)}, 10) END AS codigo_postal,
             left(coalesce(nullif({_cut("Telefono1", 30)}, '0'), nullif({_cut("Telefono2", 30)}, '0'),
                           nullif({_cut("Telefono3", 30)}, '0')), 30) AS telefono,
             'ACTIVO' AS estado,
             coalesce("TimeStamp", FechaInicioHistoria, TIMESTAMP '1900-01-01') AS actualizado_en
      FROM latest)
    SELECT * FROM mapped WHERE codigo IS NOT NULL AND nombre IS NOT NULL
    """,
)
def conform_company(spark, sf):
    raw = table(spark, sf, "orders").select(*[F.expr(text).alias(name) for name, text in RAW_COMPANY.items()])
    return company_extract(raw)


RAW_EMPLOYEE = {
    "idempleado": "o_orderkey",
    "codigoempleado": "CASE WHEN o_custkey % 50 = 0 THEN ' ' ELSE ' ' || CAST(o_custkey AS STRING) || ' ' END",
    "iddepartamento": "o_custkey % 30",
    "idpuesto": "o_orderkey % 2500",
    "nombrelargo": "CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'Person ' || CAST(o_custkey AS STRING) END",
    "CorreoElectronico": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'p' || CAST(o_custkey AS STRING) || '@example.com' END",
    "sexo": "substring(o_orderstatus, 1, 1)",
    "fechanacimiento": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END",
    "curpi": "lower(o_orderpriority)",
    "curpf": "CASE WHEN o_orderkey % 6 = 0 THEN ' ' ELSE substring(md5(CAST(o_orderkey AS STRING)), 1, 8) END",
    "rfc": "'abcd'",
    "homoclave": "substring(md5(CAST(o_custkey AS STRING)), 1, 3)",
    "NumeroFonacot": "CAST(o_orderkey AS STRING)",
    "estadocivil": "o_orderpriority",
    "lugarnacimiento": "repeat(o_orderpriority, 30)",
    "estadoempleado": "lower(o_orderstatus)",
    "fechaalta": "o_orderdate",
    "fechabaja": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END",
    "fechareingreso": "CASE WHEN o_orderstatus = 'P' THEN o_orderdate END",
    "causabaja": "CASE WHEN o_orderstatus = 'F' THEN ' ended ' END",
    "sueldodiario": "o_totalprice",
    "timestamp": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END",
}
COMPANY_ID = "00000000-AAAA-4BBB-8CCC-000000000001"


@query(
    "conform_employee",
    f"""
    WITH raw AS (SELECT {_raw_sql(RAW_EMPLOYEE)} FROM orders),
    base AS (SELECT *, {_cut("codigoempleado", 50)} AS numero_empleado FROM raw),
    latest AS (
      SELECT * FROM base WHERE numero_empleado IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY numero_empleado ORDER BY "timestamp" DESC NULLS LAST, idempleado DESC) = 1),
    departments AS (
      SELECT id, max(name) AS name FROM (SELECT n_nationkey AS id, n_name AS name FROM nation
                                         UNION ALL SELECT n_regionkey, n_name FROM nation) GROUP BY id)
    SELECT '{COMPANY_ID}' AS empresa_id, numero_empleado, {_cut("nombrelargo", 250)} AS nombre_completo,
           {_cut("d.name", 200)} AS area_contpaqi, {_cut("p_name", 200)} AS puesto_contpaqi,
           {_cut("CorreoElectronico", 254)} AS correo_electronico, {_cut("sexo", 20)} AS genero,
           strftime(fechanacimiento, '%Y-%m-%d') AS fecha_nacimiento,
           left(upper({_cut("curpi", 30)} || strftime(fechanacimiento, '%y%m%d') || {_cut("curpf", 30)}), 18) AS curp,
           left(upper({_cut("rfc", 30)} || strftime(fechanacimiento, '%y%m%d') || {_cut("homoclave", 20)}), 20) AS rfc,
           {_cut("NumeroFonacot", 50)} AS numero_fonacot, {_cut("estadocivil", 50)} AS estado_civil,
           {_cut("lugarnacimiento", 150)} AS lugar_nacimiento, upper({_cut("estadoempleado", 50)}) AS estatus_laboral,
           strftime(fechaalta, '%Y-%m-%d') AS fecha_alta, strftime(fechabaja, '%Y-%m-%d') AS fecha_baja_contpaqi,
           strftime(fechareingreso, '%Y-%m-%d') AS fecha_reingreso, {_cut("causabaja", 255)} AS motivo_baja_contpaqi,
           CAST(sueldodiario AS DECIMAL(12,2)) AS salario_diario
    FROM latest LEFT JOIN departments d ON d.id = iddepartamento LEFT JOIN part ON p_partkey = idpuesto
    WHERE {_cut("nombrelargo", 250)} IS NOT NULL
    """,
)
def conform_employee(spark, sf):
    raw = table(spark, sf, "orders").select(*[F.expr(text).alias(name) for name, text in RAW_EMPLOYEE.items()])
    nation = table(spark, sf, "nation")
    departments = nation.select(F.col("n_nationkey").alias("iddepartamento"), F.col("n_name").alias("descripcion"))
    departments = departments.unionByName(
        nation.select(F.col("n_regionkey").alias("iddepartamento"), F.col("n_name").alias("descripcion"))
    )
    positions = table(spark, sf, "part").select(F.col("p_partkey").alias("idpuesto"), F.col("p_name").alias("descripcion"))
    return employee_extract(raw, departments, positions, COMPANY_ID)
