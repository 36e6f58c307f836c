"""Fifty people in five departments: the fixture of the unit tests.

Small lookup tables are written out; events are derived from their number n with the
assignment operators of the library.
"""

from datetime import date, datetime

from pyspark.sql import functions as F

from peoplemart.functions.dates import inclusive_days
from peoplemart.functions.text import joined, zero_filled
from peoplemart.operators.assign import first_of_each, round_robin
from peoplemart.operators.keys import dense_keys
from peoplemart.sources.schemas import SOURCE, conformed
from peoplemart.sources.storage import Tables, numbers_up_to, staged

AS_OF = date(2025, 12, 31)
CALENDAR_START = date(2023, 1, 1)
CALENDAR_END = date(2025, 12, 31)

# Offices, departments with their office and head, jobs, names, programmes.
OFFICES = [
    (1, "MAD-CENTRO", "Madrid", "España", "Europa"),
    (2, "BOG-NORTE", "Bogotá", "Colombia", "LatAm"),
    (3, "MEX-POLANCO", "Ciudad de México", "México", "LatAm"),
    (4, "LIM-SANISIDRO", "Lima", "Perú", "LatAm"),
    (5, "BUE-PUERTO", "Buenos Aires", "Argentina", "Cono Sur"),
]
DEPARTMENTS = [
    (1, "Recursos Humanos", 2), (2, "Tecnología", 1), (3, "Ventas", 3), (4, "Finanzas", 4), (5, "Marketing", 5),
]
JOBS = [
    (1, "Gerente RRHH", "Senior", 8000, 14000),
    (2, "Analista RRHH", "Mid-Level", 3500, 7000),
    (3, "Desarrollador Junior", "Junior", 3000, 5500),
    (4, "Desarrollador Senior", "Senior", 7000, 13000),
    (5, "Administrador de Infraestructura", "Mid-Level", 4500, 8500),
    (6, "Analista de Ventas", "Mid-Level", 3500, 7500),
    (7, "Ejecutivo Comercial", "Junior", 2800, 6000),
    (8, "Analista Financiero", "Mid-Level", 4000, 8000),
    (9, "Contador Senior", "Senior", 7000, 12000),
    (10, "Especialista Marketing Digital", "Mid-Level", 3500, 7800),
]
HEADS = [
    ("Laura", "Gómez", "1985-03-10", "Femenino", "2018-01-15", "Gerente RRHH", 12000),
    ("Carlos", "Ruiz", "1984-06-21", "Masculino", "2017-04-03", "Desarrollador Senior", 12500),
    ("Mariana", "López", "1987-11-08", "Femenino", "2019-07-01", "Analista de Ventas", 11000),
    ("Andrés", "Morales", "1982-02-18", "Masculino", "2016-09-12", "Contador Senior", 11500),
    ("Sofía", "Paredes", "1988-05-27", "Femenino", "2020-03-20", "Especialista Marketing Digital", 9800),
]
NAMES = [  # by last digit of n
    ("Daniela", "Mendoza"), ("Juan", "Pérez"), ("Ana", "Martínez"), ("Pedro", "Rodríguez"), ("Luisa", "Fernández"),
    ("Miguel", "Torres"), ("Valentina", "Ramírez"), ("Diego", "Castro"), ("Camila", "Sánchez"), ("Jorge", "Vargas"),
]
PROGRAMMES = [
    ("Liderazgo Efectivo", "SkillCenter", 1500, "2023-02-10", "2023-02-12"),
    ("Excel Avanzado", "DataAcademy", 800, "2023-03-05", "2023-03-06"),
    ("Power BI para Análisis", "BI Labs", 1200, "2023-04-15", "2023-04-17"),
    ("Python para Automatización", "TechSchool", 1800, "2023-05-20", "2023-05-24"),
    ("Marketing Digital", "GrowthHub", 1000, "2023-06-10", "2023-06-12"),
    ("SQL Server y T-SQL", "DB Institute", 1600, "2023-07-05", "2023-07-08"),
    ("Comunicación Corporativa", "Talent Academy", 600, "2024-01-12", "2024-01-13"),
    ("Gestión del Tiempo", "SkillCenter", 500, "2024-02-20", "2024-02-20"),
    ("Finanzas para No Financieros", "FinancePro", 900, "2024-03-14", "2024-03-15"),
    ("Analítica de RR.HH.", "HR Metrics", 1400, "2024-05-10", "2024-05-12"),
]
ABSENCE_TYPES = ["Licencia Médica", "Vacaciones", "Enfermedad", "Permiso Personal"]  # by n % 4


def _pick(values, position):
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def _after(start, days):
    return F.date_add(F.to_date(F.lit(start)), days.cast("int"))


def source_tables(spark):
    made = _made(spark)
    now = F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz")
    ready = {name: staged(conformed(made[name], SOURCE[name], now), "people") for name in SOURCE}
    return Tables({name: (lambda t=table: t) for name, table in ready.items()})


def _made(spark):
    tables = {
        "Oficinas": spark.createDataFrame(
            [(*row, "28001", "+34", "Calle 1") for row in OFFICES],
            "OficinaID long, CodigoOficina string, Ciudad string, Pais string, Region string, "
            "CodigoPostal string, Telefono string, Direccion string"),
        "Departamentos": spark.createDataFrame(
            DEPARTMENTS, "DepartamentoID long, NombreDepartamento string, OficinaID long"),
        "Puestos": spark.createDataFrame(
            JOBS, "PuestoID long, NombrePuesto string, NivelSalarial string, SalarioMinimo long, SalarioMaximo long"),
        "Capacitaciones": dense_keys(spark.createDataFrame(
            [(number, *row) for number, row in enumerate(PROGRAMMES)],
            "n long, NombreCapacitacion string, Proveedor string, Costo long, FechaInicio string, FechaFin string"),
            ["n"], "CapacitacionID").withColumn(
                "DuracionDias", inclusive_days(F.to_date("FechaInicio"), F.to_date("FechaFin"))),
    }
    tables["Empleados"] = _employees(spark, tables)
    people = staged(tables["Empleados"], "employees")
    tables["Ausencias"] = _absences(spark, people)
    tables["EvaluacionesDesempeno"] = _reviews(spark, people)
    tables["EmpleadosCapacitaciones"] = _enrolments(spark, people, tables["Capacitaciones"])
    return tables


def _employees(spark, tables):
    job_ids = tables["Puestos"].select("PuestoID", "NombrePuesto")
    places = tables["Departamentos"].select("DepartamentoID", "NombreDepartamento", "OficinaID")
    heads = spark.createDataFrame(
        [(number, DEPARTMENTS[number - 1][1], f"EMP{number:03}", *row) for number, row in enumerate(HEADS, 1)],
        "EmpleadoID long, NombreDepartamento string, Identificacion string, Nombre string, Apellidos string, "
        "FechaNacimiento string, Genero string, FechaContratacion string, NombrePuesto string, SalarioActual long")
    heads = heads.withColumn("EstadoCivil", F.lit("Casado(a)")).withColumn("JefeID", F.lit(None).cast("long"))
    n = F.col("n")
    department = (F.when(n <= 8, "Recursos Humanos").when(n <= 20, "Tecnología").when(n <= 30, "Ventas")
                  .when(n <= 38, "Finanzas").otherwise("Marketing"))
    even = n % 2 == 0
    name = F.col("NombreDepartamento")
    job = (F.when(name == "Recursos Humanos", "Analista RRHH")
           .when(name == "Tecnología", F.when(even, "Desarrollador Junior").otherwise("Administrador de Infraestructura"))
           .when(name == "Ventas", F.when(even, "Ejecutivo Comercial").otherwise("Analista de Ventas"))
           .when(name == "Finanzas", "Analista Financiero").otherwise("Especialista Marketing Digital"))
    staff = (
        numbers_up_to(spark, 45)
        .withColumn("NombreDepartamento", department)
        .join(heads.select("NombreDepartamento", F.col("EmpleadoID").alias("JefeID")), "NombreDepartamento")
        .select(
            (n + 5).alias("EmpleadoID"), "NombreDepartamento",
            joined("EMP", zero_filled(n + 5, 3)).alias("Identificacion"),
            _pick([first for first, _ in NAMES], n % 10).alias("Nombre"),
            _pick([last for _, last in NAMES], n % 10).alias("Apellidos"),
            _after("1988-01-01", n * 200).cast("string").alias("FechaNacimiento"),
            F.when(even, "Femenino").otherwise("Masculino").alias("Genero"),
            _after("2020-01-01", n * 30).cast("string").alias("FechaContratacion"),
            job.alias("NombrePuesto"),
            (4000 + n * 20).alias("SalarioActual"),
            F.when(n % 3 == 0, "Casado(a)").otherwise("Soltero(a)").alias("EstadoCivil"),
            "JefeID"))
    people = heads.unionByName(staff).withColumn("Email", joined("empleado", F.col("EmpleadoID"), "@example.org"))
    return people.join(places, "NombreDepartamento").join(job_ids, "NombrePuesto")


def _events(spark, count, people):
    numbers = numbers_up_to(spark, count).withColumnRenamed("n", "evento")
    return round_robin(numbers, "evento", people, "EmpleadoID")


def _absences(spark, people):
    n = F.col("n")
    start, end = _after("2023-01-01", n * 5), _after("2023-01-01", n * 5 + n % 6)
    return _events(spark, 100, people).select(
        n.alias("AusenciaID"), "EmpleadoID", _pick(ABSENCE_TYPES, n % 4).alias("TipoAusencia"),
        start.alias("FechaInicio"), end.alias("FechaFin"), inclusive_days(start, end).alias("DiasTotales"),
        (n % 5 != 0).alias("Justificada"))


def _reviews(spark, people):
    n = F.col("n")
    heads = people.filter("JefeID IS NULL").select("DepartamentoID", F.col("EmpleadoID").alias("EvaluadorID"))
    return (
        _events(spark, 80, people)
        .join(people.select("EmpleadoID", "DepartamentoID"), "EmpleadoID").join(heads, "DepartamentoID")
        .select(n.alias("EvaluacionID"), F.col("EmpleadoID").alias("EmpleadoEvaluadoID"),
                _after("2023-01-15", n * 12).alias("FechaEvaluacion"),
                F.round(F.lit(3.0) + (n % 20) * 0.1, 1).alias("Calificacion"), "EvaluadorID"))


def _enrolments(spark, people, programmes):
    n = F.col("n")
    pairs = _events(spark, 60, people).join(
        round_robin(numbers_up_to(spark, 60).withColumnRenamed("n", "evento"), "evento",
                    programmes, "CapacitacionID").drop("evento"), "n")
    first = first_of_each(pairs, ["EmpleadoID", "CapacitacionID"], ["n"])
    pending = n % 4 == 0
    return first.select(
        n.alias("EmpleadoCapacitacionID"), "EmpleadoID", "CapacitacionID",
        F.when(~pending, 60 + n % 41).alias("CalificacionObtenida"),
        F.when(~pending, _after("2023-02-15", n * 10)).alias("FechaCompletado"),
        F.when(pending, "En Curso").otherwise("Completada").alias("Estado"))
