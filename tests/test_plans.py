"""Both conformance plans on rows that must behave in a given way."""

import datetime as dt
from decimal import Decimal

import pytest

from tidemark.operators.quality import ConformanceError, assert_subset
from tidemark.plans import companies, employees

GUID = "0a1b2c3d-0000-4000-8000-0123456789ab"
DAY = dt.date(1990, 2, 3)
LATER, EARLIER = dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1)

COMPANY = "IDEmpresa int, GUIDEmpresa string, NombreEmpresa string, NombreCorto string, NombreEmpresaFiscal string, RFC string, Homoclave string, " \
    "FechaConstitucion date, NombreRepresentante string, ApPaternoRepresentante string, ApMaternoRepresentante string, RegistroIMSS string, " \
    "RegistroInfonavit string, RegistroFonacot string, RegimenFiscal string, Direccion string, Localidad string, CodigoPostal string, " \
    "Telefono1 string, Telefono2 string, Telefono3 string, TimeStamp timestamp_ntz, FechaInicioHistoria timestamp_ntz"  # fmt: skip


def company(**given):
    base = {
        "IDEmpresa": 1, "GUIDEmpresa": f"{{{GUID}}}", "NombreEmpresa": " Acme ", "RFC": "abc", "Homoclave": "x1y", "FechaConstitucion": DAY,
        "CodigoPostal": "123", "Telefono1": "", "Telefono2": "0", "Telefono3": "555", "TimeStamp": LATER,
    }
    names = [c.split()[0] for c in COMPANY.split(", ")]
    return tuple((base | given).get(n) for n in names)


def companies_of(spark, *rows):
    return [r.asDict() for r in companies.company_extract(spark.createDataFrame(list(rows), COMPANY)).orderBy("id").collect()]


def test_company(spark):
    (row,) = companies_of(spark, company())
    assert set(row) <= set(companies.COMPANY_COLUMNS) - set(companies.PROTECTED)
    assert (row["id"], row["nombre"], row["rfc"], row["codigo_postal"], row["telefono"]) == (GUID.upper(), "Acme", "ABC900203X1Y", "00123", "555")
    assert row["registro_fonacot"] is None and row["estado"] == "ACTIVO" and row["actualizado_en"] == LATER


def test_the_newest_company_decides_even_if_it_is_left_out(spark):
    assert companies_of(spark, company(TimeStamp=EARLIER), company(NombreEmpresa="  ")) == []
    assert [r["nombre"] for r in companies_of(spark, company(TimeStamp=None, NombreEmpresa="old"), company(TimeStamp=EARLIER, NombreEmpresa="new"))] == ["new"]
    assert companies_of(spark, company(GUIDEmpresa="0"), company(GUIDEmpresa=None)) == []


EMPLOYEE = "idempleado int, codigoempleado string, iddepartamento int, idpuesto int, nombrelargo string, CorreoElectronico string, sexo string, " \
    "fechanacimiento date, curpi string, curpf string, rfc string, homoclave string, NumeroFonacot string, estadocivil string, lugarnacimiento string, " \
    "estadoempleado string, fechaalta date, fechabaja date, fechareingreso date, causabaja string, sueldodiario decimal(14,4), timestamp timestamp_ntz"  # fmt: skip


def employee(**given):
    base = {
        "idempleado": 1, "codigoempleado": " 007 ", "iddepartamento": 5, "idpuesto": 6, "nombrelargo": "Ana Paz", "fechanacimiento": DAY, "curpi": "abcd",
        "curpf": "hdf", "rfc": "abcd", "homoclave": "1a2", "estadoempleado": "alta", "fechaalta": DAY, "sueldodiario": Decimal("10.005"), "timestamp": LATER,
    }
    return tuple((base | given).get(c.split()[0]) for c in EMPLOYEE.split(", "))


def employees_of(spark, *rows, company_id=GUID.upper()):
    names = spark.createDataFrame([(5, "Sales"), (5, "Sale")], "iddepartamento int, descripcion string")
    jobs = spark.createDataFrame([(9, "Clerk")], "idpuesto int, descripcion string")
    return [r.asDict() for r in employees.employee_extract(spark.createDataFrame(list(rows), EMPLOYEE), names, jobs, company_id).collect()]


def test_employee(spark):
    (row,) = employees_of(spark, employee())
    assert set(row) <= set(employees.EMPLOYEE_COLUMNS) - set(employees.PROTECTED)
    assert set(employees.KEYS) <= set(row)
    assert (row["numero_empleado"], row["area_contpaqi"], row["puesto_contpaqi"]) == ("007", "Sales", None)
    assert (row["fecha_nacimiento"], row["curp"], row["estatus_laboral"], row["salario_diario"]) == ("1990-02-03", "ABCD900203HDF", "ALTA", Decimal("10.01"))
    assert row["fecha_baja_contpaqi"] is None and row["motivo_baja_contpaqi"] is None


def test_employees_left_out(spark):
    assert employees_of(spark, employee(codigoempleado=" ")) == []
    assert employees_of(spark, employee(timestamp=EARLIER), employee(idempleado=2, nombrelargo="")) == []
    assert employees_of(spark, employee(), company_id="0") == []


def test_plans_refuse_columns_the_target_lacks_or_protects(spark):
    with pytest.raises(ConformanceError):
        assert_subset(spark.createDataFrame([(1,)], "fecha_baja int"), employees.EMPLOYEE_COLUMNS, employees.PROTECTED)
    with pytest.raises(ConformanceError):
        assert_subset(spark.createDataFrame([(1,)], "area int"), employees.EMPLOYEE_COLUMNS)
