"""Employee extract of one company: newest row per number, lookups, target columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import clean_text, compose_code, is_guid, iso_date, money
from tidemark.operators.conform import lookup, project, require
from tidemark.operators.latest import keep_latest, newest_first
from tidemark.operators.quality import assert_subset

KEYS = ["empresa_id", "numero_empleado"]

# Target column -> source column, first cut, final cut.
EMPLOYEE_TEXT = {
    "nombre_completo": ("nombrelargo", 250, 250),
    "correo_electronico": ("CorreoElectronico", 254, 254),
    "genero": ("sexo", 20, 20),
    "numero_fonacot": ("NumeroFonacot", 50, 50),
    "estado_civil": ("estadocivil", 50, 50),
    "lugar_nacimiento": ("lugarnacimiento", 150, 150),
}

# Columns of the target table.
EMPLOYEE_COLUMNS = [
    "id", "empresa_id", "area_contpaqi", "puesto_contpaqi", "numero_empleado",
    "nombre_completo", "correo_electronico", "genero", "fecha_nacimiento",
    "curp", "rfc", "numero_fonacot", "estado_civil", "lugar_nacimiento",
    "estatus_laboral", "fecha_alta", "fecha_baja", "fecha_baja_contpaqi",
    "fecha_reingreso", "motivo_baja", "motivo_baja_contpaqi", "salario_diario",
    "transporte", "vales", "vacaciones_totales", "vacaciones_disponibles",
]

# Columns the extract must never write.
PROTECTED = [
    "id", "source_name", "fecha_baja", "motivo_baja", "transporte", "vales",
    "vacaciones_totales", "vacaciones_disponibles",
]


def descriptions(dim: DataFrame, key: str) -> DataFrame:
    """One description per lookup id, so a repeated id cannot repeat employees."""
    return dim.groupBy(key).agg(F.max("descripcion").alias("descripcion"))


def latest_employees(raw: DataFrame) -> DataFrame:
    """Newest source row per employee number; rows without a number are left out."""
    numbered = raw.withColumn("numero_empleado", clean_text("codigoempleado", 50))
    numbered = require(numbered, F.col("numero_empleado").isNotNull())
    return keep_latest(numbered, ["numero_empleado"], newest_first("timestamp", "idempleado"))


def employee_extract(raw: DataFrame, departments: DataFrame, positions: DataFrame, company_id: str) -> DataFrame:
    """Rows for the employee target, with target columns only and no protected one.

    Lookups run after the newest row is chosen, so superseded
    rows are never joined. Dates leave as text.
    """
    current = latest_employees(raw)
    current = lookup(current, descriptions(departments, "iddepartamento"),
                     {"iddepartamento": "iddepartamento"}, {"descripcion": "_department"})
    current = lookup(current, descriptions(positions, "idpuesto"),
                     {"idpuesto": "idpuesto"}, {"descripcion": "_position"})
    text = {name: clean_text(*rule) for name, rule in EMPLOYEE_TEXT.items()}
    mapped = project(
        current,
        {
            "empresa_id": F.lit(company_id),
            "numero_empleado": "numero_empleado",
            "nombre_completo": text["nombre_completo"],
            "area_contpaqi": clean_text("_department", 200),
            "puesto_contpaqi": clean_text("_position", 200),
            "correo_electronico": text["correo_electronico"],
            "genero": text["genero"],
            "fecha_nacimiento": iso_date("fechanacimiento"),
            "curp": compose_code(clean_text("curpi", 30), "fechanacimiento", clean_text("curpf", 30), 18),
            "rfc": compose_code(clean_text("rfc", 30), "fechanacimiento", clean_text("homoclave", 20), 20),
            "numero_fonacot": text["numero_fonacot"],
            "estado_civil": text["estado_civil"],
            "lugar_nacimiento": text["lugar_nacimiento"],
            "estatus_laboral": clean_text("estadoempleado", 50, upper=True),
            "fecha_alta": iso_date("fechaalta"),
            "fecha_baja_contpaqi": iso_date("fechabaja"),
            "fecha_reingreso": iso_date("fechareingreso"),
            "motivo_baja_contpaqi": clean_text("causabaja", 255),
            "salario_diario": money("sueldodiario"),
        },
    )
    assert_subset(mapped, EMPLOYEE_COLUMNS, PROTECTED)
    return require(mapped, is_guid("empresa_id"), F.col("nombre_completo").isNotNull())
