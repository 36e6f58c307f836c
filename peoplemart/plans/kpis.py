"""The fifteen KPI queries on the mart.

Each takes the mart tables by name and returns the report in its order. Facts are reduced on
their surrogate keys before a large dimension (employees, programmes) is joined, so one
employee with a huge share of the rows is folded on the map side and never meets a join.
Events are counted as rows: fact keys are never NULL, and counting them would read them.
Sort keys after the leading ones only make the order, and the top ten, repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.functions.numeric import (
    how_many, in_units, mean_rank_key, percent, ratio, sample_deviation, shifted, sum_where)
from peoplemart.functions.text import joined
from peoplemart.operators.bitmaps import member_bitmaps, member_counts

Tables = Mapping[str, DataFrame]

WORKING_DAYS = 261  # per employee and year, whatever span the data has

# Labels of the risk and alert columns.
RISK_CRITICAL = "🔴 CRÍTICO (> 5%)"
RISK_ELEVATED = "🟡 ELEVADO (3-5%)"
RISK_NORMAL = "🟢 NORMAL (< 3%)"
ALERT_HIGH = "🔴 ALERTA ALTA"
ALERT_MEDIUM = "🟡 ALERTA MEDIA"
ALERT_FOLLOW_UP = "🟢 SEGUIMIENTO"

_DEPARTMENT = ["NombreDepartamento"]
_OFFICE = ["Ciudad", "Pais", "Region"]


def _justified() -> Column:
    return F.col("JustificadaFlag")


def _days() -> Column:
    return F.col("DiasAusencia")


def _tenths() -> Column:
    return in_units(F.col("Calificacion"), 1)


def _cost_cents() -> Column:
    return in_units(F.col("CostoCapacitacion"), 2)


def _grade_cents() -> Column:
    return in_units(F.col("CalificacionObtenida"), 2)


def _completed() -> Column:
    return F.col("Estado") == "Completada"


def _labelled(df: DataFrame, dim: DataFrame, key: str, *labels: str) -> DataFrame:
    return df.join(dim.select(key, *labels), key)


def _grouped(fact: DataFrame, dim: DataFrame, key: str, labels: list[str]):
    """fact with a number per distinct label combination, and the labels of each number.

    Counting distinct employees shuffles bitmaps per group, so groups travel as one number (the
    lowest key with these labels) and get their labels after they are counted.
    """
    numbers = dim.select(key, *labels, F.min(key).over(Window.partitionBy(*labels)).alias("_group"))
    named = numbers.filter(F.col(key) == F.col("_group")).select("_group", *labels)
    return fact.join(numbers.select(key, "_group"), key), named


def _people(events: DataFrame, groups: list[str], name: str, **sums: Column) -> DataFrame:
    """The distinct employees of each group, exactly, and sums over its rows. What is shuffled is a
    bitmap for each group and 32,768 neighbouring employees, however many rows they have."""
    parts = member_bitmaps(events, groups, "EmpleadoKey", *[total.alias(alias) for alias, total in sums.items()])
    return member_counts(parts, groups, name, *[F.sum(alias).alias(alias) for alias in sums])


def _rating_histogram(ratings: DataFrame, *group: str) -> DataFrame:
    """Rows per group and rating: a few dozen rows per group, from which all statistics follow."""
    return ratings.groupBy(*group, "Calificacion").agg(F.count("*").alias("n")).withColumn("tenths", _tenths())


def _rating_statistics() -> list[Column]:
    """Aggregates over a rating histogram."""
    n, tenths = F.col("n"), F.col("tenths")
    return [
        F.sum(n).alias("TotalEvaluaciones"),
        F.sum(n * tenths).alias("total"),
        F.sum(n * tenths * tenths).alias("squares"),
        F.min("Calificacion").alias("Minima"),
        F.max("Calificacion").alias("Maxima"),
        sum_where(tenths >= 45, n).alias("Excelente"),
        sum_where(tenths.between(35, 44), n).alias("Bueno"),
        sum_where(tenths.between(25, 34), n).alias("Regular"),
        sum_where(tenths < 25, n).alias("Deficiente"),
    ]


def _mean_of(total: str, count: str, digits: int, units: int = 0) -> Column:
    """total / count at `digits` decimals, total being held in 10^-units."""
    return ratio(F.col(total), F.col(count) * 10**units, digits)


def absence_by_department_and_type(mart: Tables) -> DataFrame:
    events = mart["FactAusencias"].groupBy("DepartamentoKey", "TipoAusenciaKey").agg(
        F.count("*").alias("n"), F.sum(_days()).alias("dias"),
        how_many(_justified()).alias("just"), how_many(~_justified()).alias("injust"))
    events = _labelled(events, mart["DimDepartamento"], "DepartamentoKey", *_DEPARTMENT)
    events = _labelled(events, mart["DimTipoAusencia"], "TipoAusenciaKey", "TipoAusencia")
    return (
        events.groupBy("NombreDepartamento", "TipoAusencia")
        .agg(F.sum("n").alias("CantidadEventos"), F.sum("dias").alias("TotalDiasAusentes"),
             F.sum("just").alias("Justificadas"), F.sum("injust").alias("NoJustificadas"))
        .select(
            "NombreDepartamento", "TipoAusencia", "CantidadEventos", "TotalDiasAusentes",
            _mean_of("TotalDiasAusentes", "CantidadEventos", 2).alias("PromedioDiasPorEvento"),
            "Justificadas", "NoJustificadas",
            percent(F.col("Justificadas"), F.col("CantidadEventos"), 1).alias("PctJustificado"))
        .orderBy("NombreDepartamento", F.desc("TotalDiasAusentes"), "TipoAusencia")
    )


def ratings_by_department(mart: Tables) -> DataFrame:
    rated = _rating_histogram(mart["FactEvaluaciones"], "DepartamentoKey")
    return (
        _labelled(rated, mart["DimDepartamento"], "DepartamentoKey", *_DEPARTMENT)
        .groupBy("NombreDepartamento").agg(*_rating_statistics())
        .select(
            "NombreDepartamento", "TotalEvaluaciones",
            _mean_of("total", "TotalEvaluaciones", 1, units=1).alias("PromedioCalificacion"),
            "Minima", "Maxima",
            sample_deviation(F.col("TotalEvaluaciones"), F.col("total"), F.col("squares"), 3, 1)
            .alias("DesviacionEstandar"),
            "Excelente", "Bueno", "Regular", "Deficiente")
        .orderBy(F.desc("PromedioCalificacion"), "NombreDepartamento")
    )


def monthly_absences(mart: Tables) -> DataFrame:
    month = ["Anio", "Mes"]
    events = _labelled(mart["FactAusencias"], mart["DimFecha"], "FechaKey", *month)
    names = mart["DimFecha"].select(*month, "NombreMes").distinct()  # one per month
    return (
        _people(events, month, "EmpleadosAfectados", CantidadEventos=F.count("*"), TotalDiasAusentes=F.sum(_days()))
        .join(names, month)
        .select(*month, "NombreMes", "CantidadEventos", "TotalDiasAusentes", "EmpleadosAfectados",
                _mean_of("TotalDiasAusentes", "EmpleadosAfectados", 2).alias("DiasPromPorEmpleado"))
        .orderBy(*month)
    )


def _absences_per_person(mart: Tables, by_key: bool) -> tuple[DataFrame, list[str]]:
    """Absence sums per person, department and office.

    People of one name in one department and office count as one person unless by_key is set.
    """
    per_key = mart["FactAusencias"].groupBy("EmpleadoKey", "DepartamentoKey", "OficinaKey").agg(
        F.count("*").alias("n"), F.sum(_days()).alias("dias"),
        how_many(~_justified()).alias("injust"), sum_where(_justified(), _days()).alias("dias_just"),
        sum_where(~_justified(), _days()).alias("dias_injust"))
    named = _labelled(per_key, mart["DimEmpleado"], "EmpleadoKey", "EmpleadoID_OLTP", "NombreCompleto")
    named = _labelled(named, mart["DimDepartamento"], "DepartamentoKey", *_DEPARTMENT)
    named = _labelled(named, mart["DimOficina"], "OficinaKey", F.col("Ciudad").alias("Oficina"))
    person = ["NombreCompleto", "NombreDepartamento", "Oficina"]
    if by_key:
        person = ["EmpleadoID_OLTP", *person]
    sums = named.groupBy(*person).agg(*[
        F.sum(name).alias(name) for name in ("n", "dias", "injust", "dias_just", "dias_injust")])
    return sums, person


def top_absent_employees(mart: Tables, by_key: bool = False, limit: int = 10) -> DataFrame:
    sums, person = _absences_per_person(mart, by_key)
    return (
        sums.select(
            *person,
            F.col("n").alias("CantidadEventos"), F.col("dias").alias("TotalDiasAusentes"),
            F.col("dias_just").alias("DiasJustificados"), F.col("dias_injust").alias("DiasNoJustificados"),
            percent(F.col("dias_injust"), F.col("dias"), 1).alias("PctNoJustificado"))
        .orderBy(F.desc("TotalDiasAusentes"), "NombreCompleto", "NombreDepartamento", "Oficina", *person[:1])
        .limit(limit)
    )


def training_by_department_and_state(mart: Tables) -> DataFrame:
    trained, named = _grouped(mart["FactCapacitaciones"], mart["DimDepartamento"], "DepartamentoKey", _DEPARTMENT)
    return (
        _people(trained, ["_group", "Estado"], "EmpleadosParticipantes", Asignaciones=F.count("*"), cents=F.sum(_cost_cents()),
                grades=F.sum(_grade_cents()), graded=F.count("CalificacionObtenida"))
        .join(named, "_group")
        .select(
            "NombreDepartamento", "Estado", "Asignaciones", "EmpleadosParticipantes",
            shifted(F.col("cents"), 2).alias("InversionTotal"),
            _mean_of("cents", "EmpleadosParticipantes", 2, units=2).alias("CostoPorEmpleado"),
            _mean_of("grades", "graded", 1, units=2).alias("CalificacionPromedio"))
        .orderBy("NombreDepartamento", "Estado")
    )


def seniority_by_department(mart: Tables) -> DataFrame:
    years = F.col("AntiguedadAnios")
    active = mart["DimEmpleado"].filter("Activo").groupBy("DepartamentoID_OLTP").agg(
        F.count("*").alias("n"),
        how_many(years < 1).alias("b0"), how_many(years.between(1, 3)).alias("b1"),
        how_many(years.between(4, 7)).alias("b4"), how_many(years > 7).alias("b8"),
        F.sum(years).alias("years"))
    return (
        _labelled(active, mart["DimDepartamento"], "DepartamentoID_OLTP", *_DEPARTMENT)
        .groupBy("NombreDepartamento")
        .agg(F.sum("n").alias("TotalActivos"), F.sum("b0").alias("MenosDeUnAnio"),
             F.sum("b1").alias("De1a3Anios"), F.sum("b4").alias("De4a7Anios"),
             F.sum("b8").alias("MasDe7Anios"), F.sum("years").alias("years"))
        .withColumn("AntiguedadPromedio", _mean_of("years", "TotalActivos", 1))
        .drop("years")
        .orderBy(F.desc("AntiguedadPromedio"), "NombreDepartamento")
    )


def absence_rate(mart: Tables, years: tuple[int, int] | None = None) -> DataFrame:
    """Share of the working days of the absent employees that was lost, with a risk level.

    years limits the absences to a closed range of calendar years, whose folders alone are read.
    """
    if years:
        chosen = mart["DimFecha"].filter(F.col("Anio").between(*years)).select("FechaKey")
        events = mart.in_years("FactAusencias", *years).join(chosen, "FechaKey")
    else:
        events = mart["FactAusencias"]
    events, named = _grouped(events, mart["DimDepartamento"], "DepartamentoKey", _DEPARTMENT)
    lost, available = F.col("TotalDiasAusentes"), F.col("DiasLaborablesDisponibles")
    return (
        _people(events, ["_group"], "TotalEmpleados", TotalDiasAusentes=F.sum(_days()))
        .join(named, "_group")
        .select("NombreDepartamento", "TotalEmpleados", "TotalDiasAusentes")
        .withColumn("DiasLaborablesDisponibles", F.col("TotalEmpleados") * WORKING_DAYS)
        .withColumn("TasaAusentismoPct", percent(lost, available, 2))
        .withColumn("NivelRiesgo", F.when(lost * 100 > available * 5, RISK_CRITICAL)
                    .when(lost * 100 > available * 3, RISK_ELEVATED)
                    .otherwise(RISK_NORMAL))
        .orderBy(F.desc("TasaAusentismoPct"), "NombreDepartamento")
    )


def training_by_office(mart: Tables) -> DataFrame:
    trained, named = _grouped(mart["FactCapacitaciones"], mart["DimOficina"], "OficinaKey", _OFFICE)
    return (
        _people(trained, ["_group"], "EmpleadosCapacitados", TotalAsignaciones=F.count("*"), cents=F.sum(_cost_cents()))
        .join(named, "_group")
        .select(
            *_OFFICE, "EmpleadosCapacitados", "TotalAsignaciones",
            shifted(F.col("cents"), 2).alias("InversionTotal"),
            _mean_of("cents", "TotalAsignaciones", 2, units=2).alias("CostoPromPorAsignacion"),
            _mean_of("cents", "EmpleadosCapacitados", 2, units=2).alias("InversionPorEmpleado"))
        .orderBy(F.desc("InversionTotal"), *_OFFICE)
    )


def quarterly_ratings(mart: Tables) -> DataFrame:
    rated = _labelled(mart["FactEvaluaciones"], mart["DimFecha"], "FechaKey", "Anio", "Trimestre")
    return (
        _rating_histogram(rated, "Anio", "Trimestre")
        .groupBy("Anio", "Trimestre").agg(*_rating_statistics())
        .select(
            "Anio", "Trimestre", joined("Q", F.col("Trimestre"), "-", F.col("Anio")).alias("Periodo"),
            "TotalEvaluaciones",
            _mean_of("total", "TotalEvaluaciones", 1, units=1).alias("PromedioCalificacion"),
            "Excelente", "Bueno", "Regular", "Deficiente")
        .orderBy("Anio", "Trimestre")
    )


def gender_by_department(mart: Tables) -> DataFrame:
    active = mart["DimEmpleado"].filter("Activo").groupBy("DepartamentoID_OLTP", "Genero").agg(
        F.count("*").alias("n"))
    # the window runs over one row per department and gender
    department = Window.partitionBy("NombreDepartamento")
    return (
        _labelled(active, mart["DimDepartamento"], "DepartamentoID_OLTP", *_DEPARTMENT)
        .groupBy("NombreDepartamento", "Genero")
        .agg(F.sum("n").alias("CantidadEmpleados"))
        .withColumn("PctEnDepartamento", percent(
            F.col("CantidadEmpleados"), F.sum("CantidadEmpleados").over(department), 1))
        .orderBy("NombreDepartamento", F.desc("CantidadEmpleados"), "Genero")
    )


def best_rated_per_department(mart: Tables, by_key: bool = False, places: int = 3) -> DataFrame:
    """Employees on the first places of their department by exact mean rating, ties included.

    People are counted per department and mean first, so windows see each mean once, however many
    share it. The few means with a place are joined back by broadcast: per department, at most as
    many as there are places.
    """
    per_key = mart["FactEvaluaciones"].groupBy("EmpleadoKey", "DepartamentoKey").agg(
        F.sum(_tenths()).alias("total"), F.count("*").alias("n"))
    named = _labelled(per_key, mart["DimEmpleado"], "EmpleadoKey", "EmpleadoID_OLTP", "NombreCompleto")
    named = _labelled(named, mart["DimDepartamento"], "DepartamentoKey", *_DEPARTMENT)
    person = ["NombreCompleto", "NombreDepartamento"]
    if by_key:
        person = ["EmpleadoID_OLTP", *person]
    people = (
        named.groupBy(*person)
        .agg(F.sum("total").alias("total"), F.sum("n").alias("TotalEvaluaciones"))
        .withColumn("mean_key", mean_rank_key(F.col("total"), F.col("TotalEvaluaciones")))
    )
    best_first = Window.partitionBy("NombreDepartamento").orderBy(F.desc("mean_key"))
    above = best_first.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        people.groupBy("NombreDepartamento", "mean_key").agg(F.count("*").alias("sharing"))
        .withColumn("order", F.row_number().over(best_first)).filter(F.col("order") <= places)
        .withColumn("Ranking", (F.coalesce(F.sum("sharing").over(above), F.lit(0)) + 1).cast("int"))
        .filter(F.col("Ranking") <= places)
        .select(F.col("NombreDepartamento").alias("_department"), F.col("mean_key").alias("_mean"), "Ranking")
    )
    return (
        people.join(F.broadcast(placed), F.col("NombreDepartamento").eqNullSafe(F.col("_department"))
                    & F.col("mean_key").eqNullSafe(F.col("_mean")))
        .select(
            "NombreDepartamento", "Ranking", *person[:-1],
            _mean_of("total", "TotalEvaluaciones", 1, units=1).alias("PromedioCalif"), "TotalEvaluaciones")
        .orderBy("NombreDepartamento", "Ranking", *person[:-1])
    )


def programme_return(mart: Tables) -> DataFrame:
    per_key = mart["FactCapacitaciones"].groupBy("CapacitacionKey").agg(
        F.count("*").alias("n"), F.sum(_cost_cents()).alias("cents"),
        F.sum(_grade_cents()).alias("grades"), F.count("CalificacionObtenida").alias("graded"),
        how_many(_completed()).alias("done"), how_many(F.col("Estado") == "En Curso").alias("open"))
    programme = ["NombreCapacitacion", "Proveedor", "DuracionDias"]
    return (
        _labelled(per_key, mart["DimCapacitacion"], "CapacitacionKey", *programme)
        .groupBy(*programme)
        .agg(F.sum("n").alias("VecesAsignada"), F.sum("cents").alias("cents"),
             F.sum("grades").alias("grades"), F.sum("graded").alias("graded"),
             F.sum("done").alias("Completadas"), F.sum("open").alias("EnCurso"))
        .select(
            *programme, "VecesAsignada", shifted(F.col("cents"), 2).alias("InversionTotal"),
            _mean_of("grades", "graded", 1, units=2).alias("CalifPromedioObtenida"),
            percent(F.col("Completadas"), F.col("VecesAsignada"), 1).alias("TasaCompletitudPct"),
            "Completadas", "EnCurso")
        .orderBy(F.desc("InversionTotal"), *programme)
    )


def unjustified_absence_alerts(mart: Tables, by_key: bool = False) -> DataFrame:
    sums, person = _absences_per_person(mart, by_key)
    level = (F.when(F.col("injust") >= 3, ALERT_HIGH).when(F.col("injust") == 2, ALERT_MEDIUM)
             .otherwise(ALERT_FOLLOW_UP))
    return (
        sums.filter("injust > 0")
        .select(
            *person, F.col("injust").alias("AusenciasNoJust"), F.col("dias_injust").alias("DiasNoJust"),
            F.col("dias").alias("TotalDias"),
            percent(F.col("dias_injust"), F.col("dias"), 1).alias("PctNoJustificado"),
            level.alias("NivelAlerta"))
        .orderBy(F.desc("AusenciasNoJust"), F.desc("DiasNoJust"), *person)
    )


def yearly_dashboard(mart: Tables) -> DataFrame:
    """One row per year that has absences; the other facts are summed per year, then attached."""
    def by_year(fact: str) -> DataFrame:
        return _labelled(mart[fact], mart["DimFecha"], "FechaKey", "Anio")

    absences = _people(by_year("FactAusencias"), ["Anio"], "EmpleadosConAusencias", TotalDiasAusentes=F.sum(_days()), n=F.count("*"))
    ratings = by_year("FactEvaluaciones").groupBy("Anio").agg(
        F.sum(_tenths()).alias("total"), F.count("*").alias("rated"))
    training = by_year("FactCapacitaciones").groupBy("Anio").agg(
        F.sum(_cost_cents()).alias("cents"), how_many(_completed()).alias("done"))
    return (
        absences.join(ratings, "Anio", "left").join(training, "Anio", "left")
        .select(
            "Anio", "EmpleadosConAusencias", "TotalDiasAusentes",
            _mean_of("TotalDiasAusentes", "n", 2).alias("DiasPromPorEvento"),
            _mean_of("total", "rated", 1, units=1).alias("PromedioDesempeno"),
            shifted(F.col("cents"), 2).alias("InversionCapacitacion"),
            F.coalesce("done", F.lit(0)).alias("CapacitacionesCompletadas"))
        .orderBy("Anio")
    )


def office_summary(mart: Tables) -> DataFrame:
    """Offices with active staff. Head count and seniority look at active staff only, the
    other measures at everybody."""
    staff = (
        mart["DimEmpleado"].filter("Activo").groupBy("OficinaID_OLTP")
        .agg(F.count("*").alias("HeadcountActivo"), F.sum("AntiguedadAnios").alias("years"))
    )
    offices = _labelled(staff, mart["DimOficina"], "OficinaID_OLTP", "OficinaKey", *_OFFICE)
    ratings = mart["FactEvaluaciones"].groupBy("OficinaKey").agg(
        F.sum(_tenths()).alias("total"), F.count("*").alias("rated"))
    absences = mart["FactAusencias"].groupBy("OficinaKey").agg(F.sum(_days()).alias("TotalDiasAusentes"))
    training = mart["FactCapacitaciones"].groupBy("OficinaKey").agg(
        F.sum(_cost_cents()).alias("cents"), how_many(_completed()).alias("done"), F.count("*").alias("n"))
    return (
        offices.join(ratings, "OficinaKey", "left").join(absences, "OficinaKey", "left")
        .join(training, "OficinaKey", "left")
        .select(
            *_OFFICE, "HeadcountActivo",
            _mean_of("years", "HeadcountActivo", 1).alias("AntiguedadPromedio"),
            _mean_of("total", "rated", 1, units=1).alias("DesempenoPromedio"),
            "TotalDiasAusentes",
            shifted(F.col("cents"), 2).alias("InversionCapacitacion"),
            percent(F.col("done"), F.col("n"), 1).alias("TasaCompletitudCapPct"))
        .orderBy(F.desc("HeadcountActivo"), *_OFFICE)
    )


KPIS: dict[str, Callable[[Tables], DataFrame]] = {
    "q01": absence_by_department_and_type,
    "q02": ratings_by_department,
    "q03": monthly_absences,
    "q04": top_absent_employees,
    "q05": training_by_department_and_state,
    "q06": seniority_by_department,
    "q07": absence_rate,
    "q08": training_by_office,
    "q09": quarterly_ratings,
    "q10": gender_by_department,
    "q11": best_rated_per_department,
    "q12": programme_return,
    "q13": unjustified_absence_alerts,
    "q14": yearly_dashboard,
    "q15": office_summary,
}
