"""Company extract: clean, keep the newest row per identifier, map to the target.

The input has the source's columns; see ``COMPANY_TEXT`` and the functions for
the ones that are read. Only those reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import (
    clean_text,
    coalesce_ts,
    compose_code,
    first_valid,
    full_name,
    is_guid,
    normalize_guid,
    pad_digits,
)
from tidemark.operators.conform import project, require
from tidemark.operators.latest import keep_latest, newest_first
from tidemark.operators.quality import assert_subset

KEYS = ["id"]
PROTECTED = ["creado_en"]

# Target column -> source column, first cut, final cut.
COMPANY_TEXT = {
    "codigo": ("IDEmpresa", 50, None),
    "nombre": ("NombreEmpresa", 200, 200),
    "nombre_corto": ("NombreCorto", 100, 100),
    "nombre_fiscal": ("NombreEmpresaFiscal", 255, 200),
    "registro_patronal_imss": ("RegistroIMSS", 50, 50),
    "registro_infonavit": ("RegistroInfonavit", 50, 50),
    "registro_fonacot": ("RegistroFonacot", 50, 50),
    "regimen_fiscal": ("RegimenFiscal", 100, 100),
    "direccion": ("Direccion", 500, 500),
    "localidad": ("Localidad", 150, 150),
}

# Columns of the target table.
COMPANY_COLUMNS = [
    "id", "codigo", "nombre", "nombre_corto", "estado", "direccion", "telefono",
    "registro_patronal_imss", "rfc", "registro_infonavit", "registro_fonacot",
    "localidad", "representante_legal", "codigo_postal", "regimen_fiscal",
    "nombre_fiscal", "creado_en", "actualizado_en",
]


def latest_companies(raw: DataFrame) -> DataFrame:
    """Newest source row per normalised identifier, identifiers of the wrong shape left out."""
    keyed = raw.withColumn("id", normalize_guid("GUIDEmpresa"))
    return keep_latest(require(keyed, is_guid("id")), KEYS, newest_first("TimeStamp", "IDEmpresa"))


def company_extract(raw: DataFrame, status: str = "ACTIVO") -> DataFrame:
    """Rows for the company target.

    Code and name are required *after* the newest row is chosen: a company whose
    newest row has no name is left out, an older row does not step in. Cleaning
    runs after that choice too; it reads one row at a time, so the order does
    not matter to the result and the rows dropped by the choice cost nothing.
    """
    text = {name: clean_text(*rule) for name, rule in COMPANY_TEXT.items()}
    mapped = project(
        latest_companies(raw),
        {
            "id": "id",
            "codigo": text["codigo"],
            "nombre": text["nombre"],
            "nombre_corto": text["nombre_corto"],
            "nombre_fiscal": text["nombre_fiscal"],
            "rfc": compose_code(clean_text("RFC", 10), "FechaConstitucion", clean_text("Homoclave", 10), 20),
            "representante_legal": full_name(
                clean_text("NombreRepresentante", 80),
                clean_text("ApPaternoRepresentante", 80),
                clean_text("ApMaternoRepresentante", 80),
                max_len=200,
            ),
            "registro_patronal_imss": text["registro_patronal_imss"],
            "registro_infonavit": text["registro_infonavit"],
            "registro_fonacot": text["registro_fonacot"],
            "regimen_fiscal": text["regimen_fiscal"],
            "direccion": text["direccion"],
            "localidad": text["localidad"],
            "codigo_postal": pad_digits(clean_text("CodigoPostal", 10), 5, 10),
            "telefono": first_valid("Telefono1", "Telefono2", "Telefono3"),
            "estado": F.lit(status),
            "actualizado_en": coalesce_ts("TimeStamp", "FechaInicioHistoria"),
        },
    )
    assert_subset(mapped, COMPANY_COLUMNS, PROTECTED)
    return require(mapped, F.col("codigo").isNotNull(), F.col("nombre").isNotNull())
