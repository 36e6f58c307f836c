"""The fourteen quality checks of the mart, their detail report and their summary.

Checks on the same table share one scan of it: each table yields one row of counts, which is
then turned into one verdict row per check. Nothing is collected to decide a verdict.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplemart.functions.numeric import how_many, percent
from peoplemart.functions.text import joined
from peoplemart.operators.checks import repeated, united
from peoplemart.operators.references import reference_profile
from peoplemart.sources.schemas import MART
from peoplemart.sources.storage import counted

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    category: str
    name: str
    passed: str = ""  # detail without problems
    failed: str = ""  # detail after the number of problems


# Texts of the quality report, by check number.
CHECKS = {
    1: Check("Integridad Ref.", "FK válidas en FactAusencias (5 dimensiones)",
             "Todas las FK de FactAusencias son válidas.", " registros con FK inválida."),
    2: Check("Integridad Ref.", "FK válidas en FactEvaluaciones (doble ref. a DimEmpleado)",
             "Todas las FK de FactEvaluaciones son válidas.", " registros con FK inválida."),
    3: Check("Integridad Ref.", "FK válidas en FactCapacitaciones (6 dimensiones)",
             "Todas las FK de FactCapacitaciones son válidas.", " con FK inválida."),
    4: Check("Completitud", "Campos críticos sin NULL en DimEmpleado",
             "Todos los empleados tienen campos críticos completos.", " con campos nulos."),
    5: Check("Rango/Dominio", "Calificaciones de desempeño en rango 1.0-5.0",
             "Todas las calificaciones están en rango válido.", " fuera de rango."),
    6: Check("Rango/Dominio", "Días de ausencia positivos (DiasAusencia > 0)",
             "Todos los registros tienen DiasAusencia >= 1.", " con días inválidos."),
    7: Check("Unicidad", "Sin duplicados en DimEmpleado por EmpleadoID_OLTP",
             "DimEmpleado no tiene EmpleadoID_OLTP duplicados.", " ID duplicados."),
    8: Check("Concordancia OLTP-DWH", "Total ausencias igual en OLTP y DWH"),
    9: Check("Concordancia OLTP-DWH", "Total evaluaciones igual en OLTP y DWH"),
    10: Check("Coherencia Negocio", "Empleados activos con departamento asignado",
              "Todos los activos tienen departamento.", " activos sin departamento."),
    11: Check("Rango/Dominio", "Costos de capacitación >= 0",
              "Ningún costo negativo en FactCapacitaciones.", " con costo negativo."),
    12: Check("Coherencia Negocio", "DimFecha cubre rango {start} a {end}"),
    13: Check("Rango/Dominio", "AntiguedadAnios >= 0 en todos los empleados",
              "Todos los empleados tienen antigüedad válida.", " con antigüedad negativa."),
    14: Check("Concordancia OLTP-DWH", "Total capacitaciones igual en OLTP y DWH"),
}


def _verdict(number: int, passed: Column, detail: Column, problems: Column, **words: object) -> Column:
    check = CHECKS[number]
    return F.struct(
        F.lit(number).alias("Num"),
        F.lit(check.category).alias("Categoria"),
        F.lit(check.name.format(**words)).alias("Nombre"),
        F.when(passed, "PASS").otherwise("FAIL").alias("Estado"),
        detail.alias("Detalle"),
        problems.cast("bigint").alias("Problemas"),
    )


def _count_verdict(number: int, problems: str) -> Column:
    count, check = F.col(problems), CHECKS[number]
    detail = F.when(count == 0, check.passed).otherwise(joined(count, check.failed))
    return _verdict(number, count == 0, detail, count)


def _match_verdict(number: int) -> Column:
    source, mart = F.col("Fuente"), F.col("Filas")
    gap = F.abs(source - mart)
    detail = joined("OLTP=", source, " | DWH=", mart, " | Diferencia=", gap)
    return _verdict(number, source == mart, detail, gap)


def _fact_verdicts(
    mart: Tables, source: Tables, wanted: Collection[int], fact: str, origin: str, references: int, rule: int,
    broken: Column, match: int,
) -> DataFrame | None:
    chosen = {references, rule, match} & set(wanted)
    if not chosen:
        return None
    if chosen == {match}:
        counts = counted(mart, fact).agg(F.count("*").alias("Filas"))
    else:
        tested = MART[fact].references if references in chosen else ()
        counts = reference_profile(mart[fact], tested, mart, {"Fuera": broken} if rule in chosen else {})
    if match in chosen:
        counts = _side_by_side(counts, counted(source, origin).agg(F.count("*").alias("Fuente")))
    verdicts = {
        references: lambda: _count_verdict(references, "Huerfanas"),
        rule: lambda: _count_verdict(rule, "Fuera"),
        match: lambda: _match_verdict(match),
    }
    return _exploded(counts, [verdicts[number]() for number in sorted(chosen)])


def _side_by_side(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two rows of counts as one, without a join."""
    both = one.unionByName(other, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


def _exploded(counts: DataFrame, verdicts: list[Column]) -> DataFrame:
    return counts.select(F.inline(F.array(*verdicts)))


def _employee_verdicts(mart: Tables, wanted: Collection[int]) -> DataFrame | None:
    critical = ["NombreCompleto", "Genero", "Identificacion", "FechaContratacion"]
    rules = {
        4: F.lit(False),
        10: F.col("Activo") & F.col("DepartamentoID_OLTP").isNull(),
        13: F.col("AntiguedadAnios") < 0,
    }
    for name in critical:
        rules[4] = rules[4] | F.col(name).isNull()
    rules = {number: rule for number, rule in rules.items() if number in wanted}
    people = mart["DimEmpleado"]
    counts = [how_many(rule).alias(f"_{number}") for number, rule in rules.items()]
    row = people.agg(*counts) if rules else None
    if 7 in wanted:
        twice = repeated(people, ["EmpleadoID_OLTP"]).agg(F.count("*").alias("_7"))
        row = _side_by_side(row, twice) if row else twice
    if row is None:
        return None
    numbers = sorted([*rules, *({7} & set(wanted))])
    return _exploded(row, [_count_verdict(number, f"_{number}") for number in numbers])


def _calendar_verdict(mart: Tables, wanted: Collection[int], start: date, end: date) -> DataFrame | None:
    if 12 not in wanted:
        return None
    row = counted(mart, "DimFecha").agg(F.min("FechaCompleta").alias("first"), F.max("FechaCompleta").alias("last"))
    first, last = F.col("first"), F.col("last")
    covered = (first <= F.lit(start)) & (last >= F.lit(end))
    detail = joined("Rango real: ", first, " a ", last)
    return _exploded(row, [_verdict(12, covered, detail, F.lit(0), start=start, end=end)])


def verdicts(
    mart: Tables, source: Tables, start: date, end: date, wanted: Collection[int] = tuple(CHECKS)
) -> DataFrame:
    """One row per wanted check: Num, Categoria, Nombre, Estado, Detalle, Problemas."""
    rating, days, cost = F.col("Calificacion"), F.col("DiasAusencia"), F.col("CostoCapacitacion")
    facts = partial(_fact_verdicts, mart, source, wanted)
    parts = [
        facts("FactAusencias", "Ausencias", 1, 6, days <= 0, 8),
        facts("FactEvaluaciones", "EvaluacionesDesempeno", 2, 5, ~rating.between(1, 5), 9),
        facts("FactCapacitaciones", "EmpleadosCapacitaciones", 3, 11, cost < 0, 14),
        _employee_verdicts(mart, wanted),
        _calendar_verdict(mart, wanted, start, end),
    ]
    return united([part for part in parts if part is not None])


# Headings of the reports.
_DETAIL_HEADINGS = {"Num": "#", "Categoria": "Categoría", "Nombre": "Validación"}


def detail_report(mart: Tables, source: Tables, start: date, end: date) -> DataFrame:
    return verdicts(mart, source, start, end).orderBy("Num").withColumnsRenamed(_DETAIL_HEADINGS)


def summary_report(checked: DataFrame) -> DataFrame:
    """Totals over a detail report."""
    total, passed = F.count("*"), how_many(F.col("Estado") == "PASS")
    return checked.agg(
        total.alias("Total Validaciones"),
        passed.alias("PASS ✓"),
        how_many(F.col("Estado") == "FAIL").alias("FAIL ✗"),
        percent(passed, total, 1).alias("% Éxito"),
    )
