"""Declared constraints: clean on the fixture, and each reports an injected bad row."""

import pytest
from pyspark.sql import functions as F

from peoplemart.operators import checks
from peoplemart.sources.schemas import MART, SOURCE
from peoplemart.sources.storage import Tables
from verification.faults import faulty_mart, faulty_source


def problems(report):
    return {(row.Tabla, row.Restriccion): row.Problemas for row in report.collect() if row.Problemas}


def changed(tables, name, key, lowest, **values):
    table = tables[name]
    for column, value in values.items():
        new = F.when(F.col(key) == lowest, F.lit(value).cast(table.schema[column].dataType)).otherwise(F.col(column))
        table = table.withColumn(column, new)
    return {**{n: tables[n] for n in tables}, name: table}


def test_fixture_is_clean(source, mart):
    everything, specs = {**source, **mart}, {**SOURCE, **MART}
    assert problems(checks.key_checks(everything, specs)) == {}
    assert problems(checks.unique_checks(everything, specs, composite=False)) == {}
    assert problems(checks.unique_checks(everything, specs, composite=True)) == {}
    assert problems(checks.reference_checks(source, SOURCE)) == {}
    assert problems(checks.reference_checks(source, SOURCE, to_itself=True)) == {}
    assert problems(checks.reference_checks(mart, MART)) == {}
    for rules in (checks.domain_rules, checks.amount_rules, checks.order_rules, checks.range_rules,
                  checks.pairing_rules):
        assert problems(checks.rule_checks(source, SOURCE, rules)) == {}
    assert problems(checks.rule_checks(everything, specs, checks.filled_rules)) == {}
    assert problems(checks.rule_checks(everything, specs, checks.length_rules)) == {}


def test_inventory():
    references = [r for spec in SOURCE.values() for r in spec.references]
    assert len(references) == 10
    assert sum(len(spec.references) for spec in MART.values()) == 17
    assert sum(len(spec.unique) for spec in SOURCE.values()) == 5
    assert [len(spec.columns) for spec in SOURCE.values()] == [9, 5, 6, 17, 9, 7, 9, 8]
    assert [len(spec.columns) for spec in MART.values()] == [9, 7, 4, 6, 14, 2, 6, 9, 9, 11]


@pytest.mark.parametrize("name, values, rules, restriction", [
    ("Puestos", {"NivelSalarial": "Principal"}, checks.domain_rules, "CHECK (NivelSalarial IN (Junior, Mid-Level, Senior))"),
    ("Empleados", {"Genero": "?"}, checks.domain_rules,
     "CHECK (Genero IN (Masculino, Femenino, No Binario, Otro))"),
    ("Ausencias", {"TipoAusencia": "Otra"}, checks.domain_rules,
     "CHECK (TipoAusencia IN (Vacaciones, Enfermedad, Permiso Personal, Licencia Médica))"),
    ("EmpleadosCapacitaciones", {"Estado": "Anulada"}, checks.domain_rules, "CHECK (Estado IN (Completada, En Curso))"),
    ("Puestos", {"SalarioMinimo": 0}, checks.amount_rules, "CHECK (SalarioMinimo > 0)"),
    ("Empleados", {"SalarioActual": 0}, checks.amount_rules, "CHECK (SalarioActual > 0)"),
    ("Capacitaciones", {"Costo": -1}, checks.amount_rules, "CHECK (Costo >= 0)"),
    ("Puestos", {"SalarioMaximo": 1}, checks.order_rules, "CHECK (SalarioMaximo >= SalarioMinimo)"),
    ("Ausencias", {"FechaFin": "2020-01-01"}, checks.order_rules, "CHECK (FechaFin >= FechaInicio)"),
    ("Capacitaciones", {"FechaFin": "2020-01-01"}, checks.order_rules, "CHECK (FechaFin >= FechaInicio)"),
    ("EvaluacionesDesempeno", {"Calificacion": 0.9}, checks.range_rules, "CHECK (Calificacion BETWEEN 1.0 AND 5.0)"),
    ("EvaluacionesDesempeno", {"Calificacion": 5.1}, checks.range_rules, "CHECK (Calificacion BETWEEN 1.0 AND 5.0)"),
    ("EmpleadosCapacitaciones", {"CalificacionObtenida": 101}, checks.range_rules,
     "CHECK (CalificacionObtenida BETWEEN 0 AND 100)"),
    ("EmpleadosCapacitaciones", {"FechaCompletado": None}, checks.pairing_rules,
     "CHECK ((Estado = 'Completada') = (FechaCompletado IS NOT NULL))"),
    ("EmpleadosCapacitaciones", {"CalificacionObtenida": None}, checks.pairing_rules,
     "CHECK ((Estado = 'Completada') = (CalificacionObtenida IS NOT NULL))"),
    ("Oficinas", {"Ciudad": None}, checks.filled_rules, "NOT NULL (Ciudad)"),
    ("Oficinas", {"CodigoOficina": "X" * 21}, checks.length_rules, "LENGTH (CodigoOficina) <= 20"),
])
def test_broken_rule(source, name, values, rules, restriction):
    tables = changed(source, name, SOURCE[name].key, 1, **values)
    assert problems(checks.rule_checks(tables, SOURCE, rules)) == {(name, restriction): 1}


def test_null_satisfies_a_check(source):
    tables = changed(source, "EmpleadosCapacitaciones", "EmpleadoCapacitacionID", 1, CalificacionObtenida=None)
    assert problems(checks.rule_checks(tables, SOURCE, checks.range_rules)) == {}


def test_breaking_rows_are_returned(source):
    rows = checks.breaking(source["Empleados"], F.col("SalarioActual") > 9000)
    assert rows.count() == 45


def test_keys_and_unique_columns(source, mart):
    doubled = source["Oficinas"].union(source["Oficinas"].filter("OficinaID = 1"))
    without = source["Departamentos"].withColumn("DepartamentoID", F.lit(None).cast("long"))
    tables = {**source, "Oficinas": doubled, "Departamentos": without}
    assert problems(checks.key_checks(tables, SOURCE)) == {
        ("Oficinas", "PRIMARY KEY (OficinaID)"): 1, ("Departamentos", "PRIMARY KEY (DepartamentoID)"): 5}
    assert problems(checks.unique_checks(tables, SOURCE, composite=False)) == {
        ("Oficinas", "UNIQUE (CodigoOficina)"): 1}
    same = changed(source, "Empleados", "EmpleadoID", 2, Email="empleado1@example.org", Identificacion="EMP001")
    assert problems(checks.unique_checks(same, SOURCE, composite=False)) == {
        ("Empleados", "UNIQUE (Identificacion)"): 1, ("Empleados", "UNIQUE (Email)"): 1}
    pairs = source["EmpleadosCapacitaciones"]
    twice = {**source, "EmpleadosCapacitaciones": pairs.union(pairs.filter("EmpleadoID = 3"))}
    assert problems(checks.unique_checks(twice, SOURCE, composite=True)) == {
        ("EmpleadosCapacitaciones", "UNIQUE (EmpleadoID, CapacitacionID)"): 1}
    types = mart["DimTipoAusencia"].withColumn("TipoAusencia", F.lit("Vacaciones"))
    assert problems(checks.unique_checks({"DimTipoAusencia": types}, {"DimTipoAusencia": MART["DimTipoAusencia"]},
                                         composite=False)) == {("DimTipoAusencia", "UNIQUE (TipoAusencia)"): 1}


@pytest.mark.parametrize("name, reference", [
    (spec.name, r) for spec in SOURCE.values() for r in spec.references if spec.name != r.parent])
def test_orphans_in_the_source(source, name, reference):
    tables = changed(source, name, SOURCE[name].key, 1, **{reference.column: -1})
    label = f"FOREIGN KEY ({reference.column}) REFERENCES {reference.parent}"
    assert problems(checks.reference_checks(tables, SOURCE)) == {(name, label): 1}


def test_unknown_manager(source):
    tables = changed(source, "Empleados", "EmpleadoID", 6, JefeID=-1)
    assert problems(checks.reference_checks(tables, SOURCE, to_itself=True)) == {
        ("Empleados", "FOREIGN KEY (JefeID) REFERENCES Empleados"): 1}


def test_orphans_in_the_mart_count_rows(mart):
    facts = mart["FactAusencias"].withColumn("OficinaKey", F.lit(99).cast("long"))
    assert problems(checks.reference_checks({**mart, "FactAusencias": facts}, MART)) == {
        ("FactAusencias", "FOREIGN KEY (OficinaKey) REFERENCES DimOficina"): 100}


def test_faults_of_a_table_load_no_other(source, mart):
    def other():
        raise AssertionError("another table was asked for")

    tables = lambda all_, name: Tables({n: (lambda n=n: all_[n]) if n == name else other for n in all_})
    assert faulty_mart(tables(mart, "DimEmpleado"))["DimEmpleado"].filter("AntiguedadAnios = -1").count()
    assert faulty_source(tables(source, "Puestos"))["Puestos"].columns == source["Puestos"].columns
