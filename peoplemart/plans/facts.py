"""Fact loads: every source event with the surrogate keys of its dimensions.

Offices, departments and jobs come from the employee's current row, so they are resolved
once per employee. Each fact then joins that one table instead of five. A fact has one row per
source event and takes the event's own id as its key: unique, the same after every reload, and
free of a shuffle. How the rows lie in files is asked for where they are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplemart.functions.dates import date_key
from peoplemart.sources.storage import staged


def _employee_keys(mart, with_job: bool) -> DataFrame:
    keys = (
        mart["DimEmpleado"]
        .join(mart["DimOficina"].select("OficinaID_OLTP", "OficinaKey"), "OficinaID_OLTP")
        .join(mart["DimDepartamento"].select("DepartamentoID_OLTP", "DepartamentoKey"), "DepartamentoID_OLTP")
    )
    columns = [F.col("EmpleadoID_OLTP").alias("EmpleadoID"), "EmpleadoKey", "OficinaKey", "DepartamentoKey"]
    if with_job:
        keys = keys.join(mart["DimPuesto"].select("PuestoID_OLTP", "PuestoKey"), "PuestoID_OLTP")
        columns.append("PuestoKey")
    return keys.select(*columns)


def absences(source, mart) -> DataFrame:
    return (
        source["Ausencias"]
        .join(_employee_keys(mart, with_job=False), "EmpleadoID")
        .join(mart["DimTipoAusencia"], "TipoAusencia")
        .select(
            F.col("AusenciaID").alias("FactAusenciaKey"),
            date_key(F.col("FechaInicio")).alias("FechaKey"),
            "EmpleadoKey", "OficinaKey", "DepartamentoKey", "TipoAusenciaKey",
            F.lit(1).alias("CantidadAusencias"),
            F.col("DiasTotales").alias("DiasAusencia"),
            F.col("Justificada").alias("JustificadaFlag"),
        )
    )


def reviews(source, mart) -> DataFrame:
    """Reviews name two employees: the one reviewed and the reviewer.

    Few people review many, so their keys are looked up once per reviewer and written: the planner
    then knows whether they are few enough to broadcast.
    """
    events = source["EvaluacionesDesempeno"]
    reviewers = events.select("EvaluadorID").distinct().join(
        mart["DimEmpleado"].select(
            F.col("EmpleadoID_OLTP").alias("EvaluadorID"),
            F.col("EmpleadoKey").alias("EvaluadorEmpleadoKey")),
        "EvaluadorID")
    reviewed = _employee_keys(mart, with_job=True).withColumnRenamed("EmpleadoID", "EmpleadoEvaluadoID")
    return (
        events
        .join(reviewed, "EmpleadoEvaluadoID")
        .join(staged(reviewers, "reviewers"), "EvaluadorID")
        .select(
            F.col("EvaluacionID").alias("FactEvaluacionKey"),
            date_key(F.col("FechaEvaluacion")).alias("FechaKey"),
            "EmpleadoKey", "EvaluadorEmpleadoKey", "OficinaKey", "DepartamentoKey", "PuestoKey",
            "Calificacion",
            F.lit(1).alias("CantidadEvaluaciones"),
        )
    )


def enrolments(source, mart) -> DataFrame:
    """Enrolments; one still in progress has no date and takes the start of its programme."""
    programmes = (
        source["Capacitaciones"].select("CapacitacionID", "FechaInicio", "Costo")
        .join(mart["DimCapacitacion"].select(
            F.col("CapacitacionID_OLTP").alias("CapacitacionID"), "CapacitacionKey"), "CapacitacionID")
    )
    return (
        source["EmpleadosCapacitaciones"]
        .select("EmpleadoCapacitacionID", "EmpleadoID", "CapacitacionID", "FechaCompletado", "Estado", "CalificacionObtenida")
        .join(programmes, "CapacitacionID")
        # one date and the programme's key are all that the next shuffle needs of it
        .withColumn("FechaKey", date_key(F.coalesce("FechaCompletado", "FechaInicio")))
        .drop("FechaCompletado", "FechaInicio", "CapacitacionID")
        .join(_employee_keys(mart, with_job=True), "EmpleadoID")
        .select(
            F.col("EmpleadoCapacitacionID").alias("FactCapacitacionKey"), "FechaKey",
            "EmpleadoKey", "CapacitacionKey", "OficinaKey", "DepartamentoKey", "PuestoKey",
            "Estado", "CalificacionObtenida",
            F.lit(1).alias("CantidadAsignaciones"),
            F.col("Costo").alias("CostoCapacitacion"),
        )
    )
