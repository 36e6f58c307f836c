"""KPI results on the fixture of fifty people, against values worked out by hand."""

from decimal import Decimal

from pyspark.sql import functions as F

from peoplemart.plans import kpis
from peoplemart.plans.reload import table_counts


def rows(df, *columns):
    return [tuple(str(v) if isinstance(v, Decimal) else v for v in row) for row in df.select(*columns).collect()]


def test_loaded_counts(mart):
    counts = {row.Tabla: (row.Tipo, row.Registros) for row in table_counts(mart).collect()}
    assert counts == {
        "DimFecha": ("Dimensión", 1096), "DimOficina": ("Dimensión", 5), "DimDepartamento": ("Dimensión", 5),
        "DimPuesto": ("Dimensión", 10), "DimEmpleado": ("Dimensión", 50), "DimTipoAusencia": ("Dimensión", 4),
        "DimCapacitacion": ("Dimensión", 10), "FactAusencias": ("Hecho", 100),
        "FactEvaluaciones": ("Hecho", 80), "FactCapacitaciones": ("Hecho", 50)}
    assert mart.loaded_rows == {name: registros for name, (_, registros) in counts.items()}


def test_absence_by_department_and_type(mart):
    report = kpis.absence_by_department_and_type(mart)
    assert report.count() == 20
    total = report.agg(F.sum("CantidadEventos"), F.sum("TotalDiasAusentes"), F.sum("NoJustificadas")).first()
    assert tuple(total) == (100, 350, 20)


def test_ratings_by_department(mart):
    found = rows(kpis.ratings_by_department(mart).orderBy("NombreDepartamento"), "NombreDepartamento",
                 "TotalEvaluaciones", "PromedioCalificacion", "Minima", "Maxima", "Excelente", "Bueno", "Regular",
                 "Deficiente")
    assert found == [
        ("Finanzas", 10, "3.9", "3.0", "4.9", 4, 1, 5, 0),
        ("Marketing", 9, "3.8", "3.4", "4.5", 1, 7, 1, 0),
        ("Recursos Humanos", 18, "3.9", "3.0", "4.9", 4, 9, 5, 0),
        ("Tecnología", 26, "3.9", "3.0", "4.9", 6, 13, 7, 0),
        ("Ventas", 17, "4.1", "3.0", "4.9", 5, 10, 2, 0)]


def test_rating_deviation_matches_builtin(mart):
    expected = {
        row.NombreDepartamento: round(row.sd, 3)
        for row in mart["FactEvaluaciones"].join(mart["DimDepartamento"], "DepartamentoKey")
        .groupBy("NombreDepartamento").agg(F.stddev_samp("Calificacion").alias("sd")).collect()}
    found = {row.NombreDepartamento: float(row.DesviacionEstandar)
             for row in kpis.ratings_by_department(mart).collect()}
    assert found == expected


def test_monthly_absences(mart):
    report = kpis.monthly_absences(mart).collect()
    assert len(report) == 17
    assert (report[0].Anio, report[0].NombreMes, report[-1].Anio, report[-1].NombreMes) == (2023, "Enero", 2024, "Mayo")
    assert sum(row.TotalDiasAusentes for row in report) == 350


def test_top_absent_employees_merge_namesakes(mart):
    found = rows(kpis.top_absent_employees(mart), "NombreCompleto", "TotalDiasAusentes", "CantidadEventos")
    assert found[:2] == [("Daniela Mendoza", 16, 4), ("Jorge Vargas", 12, 4)]
    assert [row[1:] for row in found[2:9]] == [(10, 2)] * 7
    assert found[9][1] == 8
    assert kpis.top_absent_employees(mart, limit=1000).count() == 48
    assert kpis.top_absent_employees(mart, by_key=True, limit=1000).count() == 50


def test_training_by_department_and_state(mart):
    report = kpis.training_by_department_and_state(mart).collect()
    assert len(report) == 10
    assert sum(row.InversionTotal for row in report) == Decimal("56500.00")
    assert all(row.CalificacionPromedio is None for row in report if row.Estado == "En Curso")


def test_seniority_bands_add_up(mart):
    report = kpis.seniority_by_department(mart).collect()
    assert {row.NombreDepartamento: row.TotalActivos for row in report} == {
        "Recursos Humanos": 9, "Tecnología": 13, "Ventas": 11, "Finanzas": 9, "Marketing": 8}
    assert all(row.MenosDeUnAnio + row.De1a3Anios + row.De4a7Anios + row.MasDe7Anios == row.TotalActivos
               for row in report)


def test_absence_rate(mart):
    found = rows(kpis.absence_rate(mart), "NombreDepartamento", "TotalEmpleados", "TotalDiasAusentes",
                 "DiasLaborablesDisponibles", "TasaAusentismoPct", "NivelRiesgo")
    assert found == [
        ("Ventas", 11, 84, 2871, "2.93", kpis.RISK_NORMAL),
        ("Marketing", 8, 58, 2088, "2.78", kpis.RISK_NORMAL),
        ("Tecnología", 13, 92, 3393, "2.71", kpis.RISK_NORMAL),
        ("Finanzas", 9, 58, 2349, "2.47", kpis.RISK_NORMAL),
        ("Recursos Humanos", 9, 58, 2349, "2.47", kpis.RISK_NORMAL)]


def test_absence_rate_levels_are_strict(spark, mart):
    """Exactly 5 % is elevated and exactly 3 % is normal: 261 days, 100 people."""
    department = mart["DimDepartamento"].first().DepartamentoKey
    for days, level in [(1305, kpis.RISK_ELEVATED), (1306, kpis.RISK_CRITICAL), (783, kpis.RISK_NORMAL),
                        (784, kpis.RISK_ELEVATED)]:
        facts = spark.range(100).select(
            F.col("id").alias("EmpleadoKey"), F.lit(department).alias("DepartamentoKey"),
            F.when(F.col("id") == 0, days).otherwise(0).alias("DiasAusencia"))
        row = kpis.absence_rate({"FactAusencias": facts, "DimDepartamento": mart["DimDepartamento"]}).first()
        assert (row.DiasLaborablesDisponibles, row.NivelRiesgo) == (26100, level)


def test_training_by_office(mart):
    found = {row.Ciudad: int(row.InversionTotal) for row in kpis.training_by_office(mart).collect()}
    assert found == {"Bogotá": 10000, "Madrid": 14900, "Ciudad de México": 12500, "Lima": 10300, "Buenos Aires": 8800}


def test_quarterly_ratings(mart):
    report = kpis.quarterly_ratings(mart).collect()
    assert [row.TotalEvaluaciones for row in report] == [6, 7, 8, 8, 7, 8, 8, 7, 8, 7, 6]
    assert (report[0].Periodo, report[-1].Periodo) == ("Q1-2023", "Q3-2025")
    assert all(row.Excelente + row.Bueno + row.Regular + row.Deficiente == row.TotalEvaluaciones for row in report)


def test_gender_by_department(mart):
    report = kpis.gender_by_department(mart).collect()
    counts = {(row.NombreDepartamento, row.Genero): row.CantidadEmpleados for row in report}
    women = {"Recursos Humanos": 5, "Tecnología": 6, "Ventas": 6, "Finanzas": 4, "Marketing": 4}
    men = {"Recursos Humanos": 4, "Tecnología": 7, "Ventas": 5, "Finanzas": 5, "Marketing": 4}
    assert counts == {**{(name, "Femenino"): n for name, n in women.items()},
                      **{(name, "Masculino"): n for name, n in men.items()}}
    for name in women:
        shares = [row.PctEnDepartamento for row in report if row.NombreDepartamento == name]
        assert abs(sum(shares) - 100) <= Decimal("0.1") * len(shares)


def test_best_rated_per_department(mart):
    found = rows(kpis.best_rated_per_department(mart), "NombreDepartamento", "Ranking", "NombreCompleto",
                 "PromedioCalif")
    assert found == [
        ("Finanzas", 1, "Luisa Fernández", "4.9"), ("Finanzas", 2, "Pedro Rodríguez", "4.8"),
        ("Finanzas", 3, "Ana Martínez", "4.7"),
        ("Marketing", 1, "Miguel Torres", "4.0"), ("Marketing", 1, "Sofía Paredes", "4.0"),
        ("Marketing", 3, "Luisa Fernández", "3.9"),
        *[("Recursos Humanos", *row[1:]) for row in found[6:9]],
        *[("Tecnología", *row[1:]) for row in found[9:12]],
        ("Ventas", 1, "Daniela Mendoza", found[12][3]),
        ("Ventas", 2, "Jorge Vargas", "4.4"), ("Ventas", 2, "Luisa Fernández", "4.4")]
    for part in (found[6:9], found[9:12]):
        assert [row[1:3] for row in part] == [(1, "Luisa Fernández"), (2, "Pedro Rodríguez"), (3, "Ana Martínez")]


def test_programme_return(mart):
    report = {row.NombreCapacitacion: row for row in kpis.programme_return(mart).collect()}
    ordered = [report[name] for name in (
        "Liderazgo Efectivo", "Excel Avanzado", "Power BI para Análisis", "Python para Automatización",
        "Marketing Digital", "SQL Server y T-SQL", "Comunicación Corporativa", "Gestión del Tiempo",
        "Finanzas para No Financieros", "Analítica de RR.HH.")]
    assert [int(row.InversionTotal) for row in ordered] == [7500, 4000, 6000, 9000, 5000, 8000, 3000, 2500, 4500, 7000]
    assert [row.Completadas for row in ordered] == [5, 3, 5, 2, 5, 3, 5, 2, 5, 3]
    assert all(row.VecesAsignada == 5 == row.Completadas + row.EnCurso for row in ordered)


def test_unjustified_absence_alerts(mart):
    found = rows(kpis.unjustified_absence_alerts(mart), "AusenciasNoJust", "NivelAlerta")
    assert found == [(4, kpis.ALERT_HIGH)] + [(2, kpis.ALERT_MEDIUM)] * 8


def test_yearly_dashboard_follows_absence_years(mart):
    """Reviews of 2025 have no absence year to appear in."""
    found = rows(kpis.yearly_dashboard(mart), "Anio", "EmpleadosConAusencias", "TotalDiasAusentes",
                 "PromedioDesempeno", "InversionCapacitacion", "CapacitacionesCompletadas")
    assert found == [(2023, 50, 252, "3.8", "37200.00", 24), (2024, 28, 98, "4.1", "19300.00", 14)]


def test_office_summary(mart):
    found = {row.Ciudad: (row.HeadcountActivo, str(row.AntiguedadPromedio), str(row.DesempenoPromedio),
                          row.TotalDiasAusentes, int(row.InversionCapacitacion), str(row.TasaCompletitudCapPct))
             for row in kpis.office_summary(mart).collect()}
    assert found == {
        "Bogotá": (9, "5.2", "3.9", 58, 10000, "77.8"), "Madrid": (13, "4.6", "3.9", 92, 14900, "76.9"),
        "Ciudad de México": (11, "3.6", "4.1", 84, 12500, "81.8"), "Lima": (9, "3.4", "3.9", 58, 10300, "66.7"),
        "Buenos Aires": (8, "2.4", "3.8", 58, 8800, "75.0")}


def test_office_summary_keeps_history_of_inactive_staff(mart):
    """An office without active staff disappears; otherwise inactive people count in the facts only."""
    people = mart["DimEmpleado"]
    lima = mart["DimOficina"].filter("Ciudad = 'Lima'").first().OficinaID_OLTP
    changed = people.withColumn("Activo", ~((F.col("OficinaID_OLTP") == lima) | (F.col("EmpleadoID_OLTP") == 1)))
    tables = {**{name: mart[name] for name in mart}, "DimEmpleado": changed}
    found = {row.Ciudad: (row.HeadcountActivo, row.TotalDiasAusentes) for row in kpis.office_summary(tables).collect()}
    assert "Lima" not in found
    assert found["Bogotá"] == (8, 58)


def test_empty_years_give_zero_counts_and_missing_sums(mart):
    tables = {**{name: mart[name] for name in mart},
              "FactCapacitaciones": mart["FactCapacitaciones"].filter("false")}
    row = kpis.yearly_dashboard(tables).first()
    assert row.CapacitacionesCompletadas == 0 and row.InversionCapacitacion is None
