"""Dimension loads from the source tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplemart.functions.dates import calendar_years, complete_years
from peoplemart.functions.text import joined
from peoplemart.operators.keys import dense_keys
from peoplemart.sources.storage import staged


def offices(source) -> DataFrame:
    rows = source["Oficinas"].select(
        F.col("OficinaID").alias("OficinaID_OLTP"), "CodigoOficina", "Ciudad", "Pais", "Region", "CodigoPostal")
    return dense_keys(rows, ["OficinaID_OLTP"], "OficinaKey")


def departments(source) -> DataFrame:
    rows = source["Departamentos"].select(
        F.col("DepartamentoID").alias("DepartamentoID_OLTP"), "NombreDepartamento", "Descripcion")
    return dense_keys(rows, ["DepartamentoID_OLTP"], "DepartamentoKey")


def jobs(source) -> DataFrame:
    rows = source["Puestos"].select(
        F.col("PuestoID").alias("PuestoID_OLTP"), "NombrePuesto", "NivelSalarial", "SalarioMinimo", "SalarioMaximo")
    return dense_keys(rows, ["PuestoID_OLTP"], "PuestoKey")


def employee_rows(source, as_of: date, full_years: bool = False) -> DataFrame:
    """Employees as they are now (SCD type 1), with age and seniority at as_of.

    Seniority counts year boundaries; full_years=True counts completed years instead.
    """
    today = F.lit(as_of)
    seniority = complete_years if full_years else calendar_years
    return source["Empleados"].select(
        F.col("EmpleadoID").alias("EmpleadoID_OLTP"),
        "Identificacion",
        joined(F.col("Nombre"), " ", F.col("Apellidos")).alias("NombreCompleto"),
        "Genero",
        "EstadoCivil",
        complete_years(F.col("FechaNacimiento"), today).alias("Edad"),
        "FechaContratacion",
        seniority(F.col("FechaContratacion"), today).alias("AntiguedadAnios"),
        "Activo",
        F.col("DepartamentoID").alias("DepartamentoID_OLTP"),
        F.col("PuestoID").alias("PuestoID_OLTP"),
        F.col("OficinaID").alias("OficinaID_OLTP"),
        F.col("JefeID").alias("JefeID_OLTP"),
    )


def employees(source, as_of: date, full_years: bool = False) -> DataFrame:
    return dense_keys(employee_rows(source, as_of, full_years), ["EmpleadoID_OLTP"], "EmpleadoKey")


def absence_types(source) -> DataFrame:
    """The types that occur, numbered in alphabetical order."""
    found = staged(source["Ausencias"].select("TipoAusencia").distinct(), "types")
    return dense_keys(found, ["TipoAusencia"], "TipoAusenciaKey")


def programmes(source) -> DataFrame:
    rows = source["Capacitaciones"].select(
        F.col("CapacitacionID").alias("CapacitacionID_OLTP"), "NombreCapacitacion", "Proveedor", "Costo", "DuracionDias")
    return dense_keys(rows, ["CapacitacionID_OLTP"], "CapacitacionKey")
