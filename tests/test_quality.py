"""The fourteen checks: all pass on good data, and each catches its own kind of bad row."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from peoplemart.plans import quality
from peoplemart.plans.calendar import calendar
from tests.people import CALENDAR_END, CALENDAR_START


def verdict(tables, source, number):
    row = quality.verdicts(tables, source, CALENDAR_START, CALENDAR_END, [number]).collect()
    assert [r.Num for r in row] == [number]
    return row[0].Estado, row[0].Problemas, row[0].Detalle


def with_table(mart, name, table):
    return {**{n: mart[n] for n in mart}, name: table}


def first_row_changed(mart, name, key, **values):
    """The table with new values in the row that has the lowest key."""
    table = mart[name]
    lowest = table.agg(F.min(key)).first()[0]
    for column, value in values.items():
        kind = table.schema[column].dataType
        changed = F.when(F.col(key) == lowest, F.lit(value).cast(kind)).otherwise(F.col(column))
        table = table.withColumn(column, changed)
    return with_table(mart, name, table)


def test_everything_passes(mart, source):
    report = quality.detail_report(mart, source, CALENDAR_START, CALENDAR_END)
    found = report.collect()
    assert report.columns == ["#", "Categoría", "Validación", "Estado", "Detalle", "Problemas"]
    assert [row["#"] for row in found] == list(range(1, 15))
    assert {(row.Estado, row.Problemas) for row in found} == {("PASS", 0)}
    details = {row["#"]: row.Detalle for row in found}
    assert details[8] == "OLTP=100 | DWH=100 | Diferencia=0"
    assert details[12] == "Rango real: 2023-01-01 a 2025-12-31"
    summary = quality.summary_report(report)
    assert summary.columns == ["Total Validaciones", "PASS ✓", "FAIL ✗", "% Éxito"]
    assert [str(value) for value in summary.first()] == ["14", "14", "0", "100.0"]


FACTS = {1: ("FactAusencias", "FactAusenciaKey"), 2: ("FactEvaluaciones", "FactEvaluacionKey"),
         3: ("FactCapacitaciones", "FactCapacitacionKey")}


@pytest.mark.parametrize("number, column", [
    *[(1, c) for c in ("FechaKey", "EmpleadoKey", "OficinaKey", "DepartamentoKey", "TipoAusenciaKey")],
    *[(2, c) for c in ("FechaKey", "EmpleadoKey", "EvaluadorEmpleadoKey", "OficinaKey", "PuestoKey")],
    *[(3, c) for c in ("FechaKey", "EmpleadoKey", "CapacitacionKey", "DepartamentoKey", "PuestoKey")]])
@pytest.mark.parametrize("value", [-1, None])
def test_unresolved_reference(mart, source, number, column, value):
    fact, key = FACTS[number]
    tables = first_row_changed(mart, fact, key, **{column: value})
    state, problems, detail = verdict(tables, source, number)
    assert (state, problems) == ("FAIL", 1) and detail.startswith("1 ")


def test_row_with_several_bad_references_counts_once(mart, source):
    tables = first_row_changed(mart, "FactCapacitaciones", "FactCapacitacionKey",
                               EmpleadoKey=-1, CapacitacionKey=-1, FechaKey=-1)
    assert verdict(tables, source, 3)[:2] == ("FAIL", 1)


def test_date_outside_the_calendar_is_an_unresolved_reference(spark, mart, source):
    tables = with_table(mart, "DimFecha", calendar(spark, date(2024, 1, 1), CALENDAR_END))
    assert verdict(tables, source, 1)[:2] == ("FAIL", 72)


@pytest.mark.parametrize("number, name, key, values", [
    (4, "DimEmpleado", "EmpleadoKey", {"NombreCompleto": None}),
    (4, "DimEmpleado", "EmpleadoKey", {"Genero": None}),
    (4, "DimEmpleado", "EmpleadoKey", {"Identificacion": None}),
    (4, "DimEmpleado", "EmpleadoKey", {"FechaContratacion": None}),
    (5, "FactEvaluaciones", "FactEvaluacionKey", {"Calificacion": 0.9}),
    (5, "FactEvaluaciones", "FactEvaluacionKey", {"Calificacion": 5.1}),
    (6, "FactAusencias", "FactAusenciaKey", {"DiasAusencia": 0}),
    (10, "DimEmpleado", "EmpleadoKey", {"DepartamentoID_OLTP": None}),
    (11, "FactCapacitaciones", "FactCapacitacionKey", {"CostoCapacitacion": -1}),
    (13, "DimEmpleado", "EmpleadoKey", {"AntiguedadAnios": -1}),
])
def test_bad_value(mart, source, number, name, key, values):
    assert verdict(first_row_changed(mart, name, key, **values), source, number)[:2] == ("FAIL", 1)


def test_inactive_employee_may_lack_a_department(mart, source):
    tables = first_row_changed(mart, "DimEmpleado", "EmpleadoKey", DepartamentoID_OLTP=None, Activo=False)
    assert verdict(tables, source, 10)[:2] == ("PASS", 0)


def test_repeated_employee_counts_keys_not_rows(mart, source):
    people = mart["DimEmpleado"]
    again = people.filter("EmpleadoID_OLTP = 7")
    tables = with_table(mart, "DimEmpleado", people.union(again).union(again))
    assert verdict(tables, source, 7)[:2] == ("FAIL", 1)


@pytest.mark.parametrize("number, fact, key", [
    (8, "FactAusencias", "FactAusenciaKey"), (9, "FactEvaluaciones", "FactEvaluacionKey"),
    (14, "FactCapacitaciones", "FactCapacitacionKey")])
def test_missing_fact_row(mart, source, number, fact, key):
    lowest = mart[fact].agg(F.min(key)).first()[0]
    tables = with_table(mart, fact, mart[fact].filter(F.col(key) != lowest))
    state, problems, detail = verdict(tables, source, number)
    assert (state, problems) == ("FAIL", 1) and detail.endswith("Diferencia=1")


def test_short_calendar_fails_without_problems(spark, mart, source):
    tables = with_table(mart, "DimFecha", calendar(spark, CALENDAR_START, date(2025, 12, 30)))
    assert verdict(tables, source, 12) == ("FAIL", 0, "Rango real: 2023-01-01 a 2025-12-30")


def test_empty_tables(spark, mart, source):
    tables = {name: mart[name].filter("false") for name in mart}
    nothing = {name: source[name].filter("false") for name in source}
    found = quality.verdicts(tables, nothing, CALENDAR_START, CALENDAR_END).collect()
    assert {row.Num: row.Estado for row in found} == {**{n: "PASS" for n in range(1, 15)}, 12: "FAIL"}
    assert all(row.Detalle is not None for row in found)
