"""The source tables and the mart with faults put in by fixed rules, so that every check has something to find.

The oracle states the same rules in SQL of its own.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplemart.plans.calendar import calendar
from peoplemart.plans.reload import Mart
from peoplemart.sources.storage import Tables

_Changes = dict[str, tuple[int, Column]]  # column: each row whose key is a multiple of the number gets the value


def _changed(df: DataFrame, key: str, changes: _Changes) -> DataFrame:
    return df.withColumns({
        name: F.when(F.col(key) % step == 0, value.cast(df.schema[name].dataType)).otherwise(F.col(name))
        for name, (step, value) in changes.items()})


def _repeated(df: DataFrame, key: str, step: int) -> DataFrame:
    return df.unionAll(df.filter(F.col(key) % step == 0))


def _without(df: DataFrame, key: str, step: int) -> DataFrame:
    return df.filter(F.col(key) % step != 0)


def faulty_source(source: Tables) -> Tables:
    lost, none = F.lit(-1), F.lit(None)
    early = F.date_sub("FechaInicio", 1)
    # each made on first use, so that a check of one table doesn't load the others
    return source.replaced(
        Oficinas=lambda: _repeated(source["Oficinas"], "OficinaID", 7),
        Departamentos=lambda: _repeated(source["Departamentos"], "DepartamentoID", 2),
        Puestos=lambda: _changed(source["Puestos"], "PuestoID", {
            "SalarioMinimo": (13, lost), "SalarioMaximo": (11, F.lit(-5)), "NivelSalarial": (17, F.lit("x" * 25))}),
        Empleados=lambda: _changed(source["Empleados"], "EmpleadoID", {
            "JefeID": (13, F.lit(-5)), "SalarioActual": (11, F.lit(0)), "Email": (17, none),
            "Genero": (19, F.lit("Ninguno")), "Nombre": (23, F.lit("x" * 81)), "OficinaID": (29, lost)}),
        Ausencias=lambda: _repeated(_changed(source["Ausencias"], "AusenciaID", {
            "EmpleadoID": (97, lost), "FechaFin": (89, early)}), "AusenciaID", 103),
        EvaluacionesDesempeno=lambda: _changed(source["EvaluacionesDesempeno"], "EvaluacionID", {
            "Calificacion": (89, F.lit("5.1")), "EvaluadorID": (97, lost)}),
        Capacitaciones=lambda: _changed(source["Capacitaciones"], "CapacitacionID", {"Costo": (7, lost), "FechaFin": (11, early)}),
        EmpleadosCapacitaciones=lambda: _changed(source["EmpleadosCapacitaciones"], "EmpleadoCapacitacionID", {
            "CalificacionObtenida": (89, F.lit(101)), "FechaCompletado": (83, none), "CapacitacionID": (97, lost)}),
    )


def faulty_mart(mart: Mart) -> Tables:
    lost, none = F.lit(-1), F.lit(None)
    return mart.replaced(
        DimFecha=lambda: calendar(mart.spark, date(1995, 1, 1), date(2000, 12, 31)),
        DimOficina=lambda: _repeated(mart["DimOficina"], "OficinaKey", 7),
        DimEmpleado=lambda: _repeated(_changed(mart["DimEmpleado"], "EmpleadoKey", {
            "Genero": (13, none), "DepartamentoID_OLTP": (17, none), "AntiguedadAnios": (19, lost)}), "EmpleadoKey", 23),
        DimTipoAusencia=lambda: _repeated(mart["DimTipoAusencia"], "TipoAusenciaKey", 2),
        FactAusencias=lambda: _without(_changed(mart["FactAusencias"], "FactAusenciaKey", {
            "EmpleadoKey": (97, lost), "DiasAusencia": (89, F.lit(0))}), "FactAusenciaKey", 101),
        FactEvaluaciones=lambda: _without(_changed(mart["FactEvaluaciones"], "FactEvaluacionKey", {
            "EvaluadorEmpleadoKey": (97, lost), "Calificacion": (89, F.lit("5.1"))}), "FactEvaluacionKey", 101),
        FactCapacitaciones=lambda: _without(_changed(mart["FactCapacitaciones"], "FactCapacitacionKey", {
            "CapacitacionKey": (97, none), "CostoCapacitacion": (89, lost)}), "FactCapacitacionKey", 101),
    )
