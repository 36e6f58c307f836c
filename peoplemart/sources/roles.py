"""The generic test tables seen as the eight source tables.

Customers play the employees, orders their absences, line items their reviews and
enrolments, parts the training programmes. Tables that are plain projections stay lazy;
those that need an aggregate or a number per row are written once to the shared folder.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplemart.functions.dates import inclusive_days
from peoplemart.functions.text import joined, zero_filled
from peoplemart.operators.assign import first_of_each, with_managers
from peoplemart.operators.keys import dense_keys
from peoplemart.sources.schemas import SOURCE, conformed
from peoplemart.sources.storage import Tables, read_table, staged

AS_OF = date(2001, 6, 30)
CALENDAR_START = date(1995, 1, 1)
CALENDAR_END = date(2001, 12, 31)

# orders the line items; unique in the test tables
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]


def role_tables(spark: SparkSession, folder: str) -> Tables:
    """The eight source tables read from the test tables in folder."""
    roles = _Roles(spark, folder)
    makers = {
        "Oficinas": roles.offices,
        "Departamentos": roles.departments,
        "Puestos": roles.jobs,
        "Empleados": roles.employees,
        "Ausencias": roles.absences,
        "EvaluacionesDesempeno": roles.reviews,
        "Capacitaciones": roles.programmes,
        "EmpleadosCapacitaciones": roles.enrolments,
    }
    now = F.lit(datetime(AS_OF.year, AS_OF.month, AS_OF.day)).cast("timestamp_ntz")
    return Tables({
        name: (lambda n=name, make=maker: conformed(make(), SOURCE[n], now))
        for name, maker in makers.items()
    })


def _chosen(position: Column, *values: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def _days_after(start: date, days: Column) -> Column:
    return F.date_add(F.lit(start), days.cast("int"))


def _money(value: str) -> Column:
    return F.col(value).cast("decimal(12,2)")


class _Roles:
    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._given = Tables({
            name: (lambda n=name: read_table(spark, folder, n))
            for name in ("region", "nation", "customer", "part", "orders", "lineitem")})
        self._prepared = Tables({"segments": self._segment_table})

    def _read(self, name: str) -> DataFrame:
        return self._given[name]

    def offices(self) -> DataFrame:
        nation = self._read("nation").join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return nation.select(
            F.col("n_nationkey").alias("OficinaID"),
            joined(F.col("r_name"), "-", F.col("n_nationkey")).alias("CodigoOficina"),
            F.col("n_name").alias("Ciudad"),
            F.col("n_name").alias("Pais"),
            F.col("r_name").alias("Region"),
            zero_filled(F.col("n_nationkey"), 5).alias("CodigoPostal"),
            joined(F.col("n_name"), ", ", F.col("r_name")).alias("Direccion"),
        )

    def _segment_table(self) -> DataFrame:
        """One row per department with its head (lowest employee id) and an office."""
        found = self._read("customer").groupBy("c_mktsegment").agg(
            F.min("c_custkey").alias("HeadID"), F.min("c_nationkey").alias("OficinaID"))
        return dense_keys(staged(found, "segments"), ["c_mktsegment"], "DepartamentoID")

    def departments(self) -> DataFrame:
        return self._prepared["segments"].select(
            "DepartamentoID", F.col("c_mktsegment").alias("NombreDepartamento"),
            joined("Area ", F.col("c_mktsegment")).alias("Descripcion"), "OficinaID")

    def jobs(self) -> DataFrame:
        bands = staged(self._read("part").groupBy("p_type").agg(
            F.min(_money("p_retailprice")).alias("SalarioMinimo"),
            F.max(_money("p_retailprice")).alias("SalarioMaximo")), "bands")
        jobs = dense_keys(bands, ["p_type"], "PuestoID").withColumnRenamed("p_type", "NombrePuesto")
        level = _chosen(F.col("PuestoID") % 3, "Senior", "Junior", "Mid-Level")
        return jobs.withColumn("NivelSalarial", level)

    def employees(self) -> DataFrame:
        person = F.col("c_custkey")
        people = with_managers(
            self._read("customer"), self._prepared["segments"].drop("OficinaID"),
            "c_mktsegment", "c_custkey", "JefeID")
        return people.select(
            person.alias("EmpleadoID"),
            joined("EMP-", person).alias("Identificacion"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("Nombre"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("Apellidos"),
            _days_after(date(1950, 1, 1), person * 41 % 9000).alias("FechaNacimiento"),
            _chosen(person % 4, "Masculino", "Femenino", "No Binario", "Otro").alias("Genero"),
            F.when(person % 3 == 0, "Casado(a)").otherwise("Soltero(a)").alias("EstadoCivil"),
            joined("empleado", person, "@example.org").alias("Email"),
            _days_after(date(1990, 1, 1), person * 37 % 4190).alias("FechaContratacion"),
            "DepartamentoID",
            (person % 6 + 1).alias("PuestoID"),
            (_money("c_acctbal") + 10000).alias("SalarioActual"),
            "JefeID",
            F.col("c_nationkey").alias("OficinaID"),
            (F.col("c_acctbal") >= 0).alias("Activo"),
        )

    def absences(self) -> DataFrame:
        start = F.col("o_orderdate").cast("date")
        end = F.date_add(start, (F.col("o_orderkey") % 6).cast("int"))
        return self._read("orders").select(
            F.col("o_orderkey").alias("AusenciaID"),
            F.col("o_custkey").alias("EmpleadoID"),
            F.col("o_orderpriority").alias("TipoAusencia"),
            start.alias("FechaInicio"),
            end.alias("FechaFin"),
            inclusive_days(start, end).alias("DiasTotales"),
            (F.col("o_orderstatus") != "F").alias("Justificada"),
        )

    def reviews(self) -> DataFrame:
        # the head is attached to the orders, which are fewer than the line items
        heads = self._read("customer").join(self._prepared["segments"], "c_mktsegment").select("c_custkey", "HeadID")
        reviewed = (
            self._read("orders").select("o_orderkey", "o_custkey")
            .join(heads, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "o_custkey", "HeadID")
        )
        tenths = F.col("l_quantity").cast("int") % 41 + 10
        lines = self._read("lineitem").join(reviewed, F.col("l_orderkey") == F.col("o_orderkey"))
        return dense_keys(lines, LINE_ORDER, "EvaluacionID", [
            F.col("o_custkey").alias("EmpleadoEvaluadoID"),
            F.col("l_shipdate").cast("date").alias("FechaEvaluacion"),
            (tenths.cast("decimal(3,0)") * F.lit("0.1").cast("decimal(1,1)")).cast("decimal(3,1)").alias("Calificacion"),
            F.col("HeadID").alias("EvaluadorID"),
        ])

    def programmes(self) -> DataFrame:
        start = _days_after(date(1995, 1, 1), F.col("p_partkey") % 2000)
        end = F.date_add(start, F.col("p_size") - 1)
        return self._read("part").select(
            F.col("p_partkey").alias("CapacitacionID"),
            F.col("p_name").alias("NombreCapacitacion"),
            F.col("p_brand").alias("Proveedor"),
            _money("p_retailprice").alias("Costo"),
            start.alias("FechaInicio"),
            end.alias("FechaFin"),
            inclusive_days(start, end).alias("DuracionDias"),
        )

    def enrolments(self) -> DataFrame:
        pending = F.col("l_returnflag") == "N"
        first = first_of_each(enrolment_lines(self._spark, self._folder), ["o_custkey", "l_partkey"], LINE_ORDER)
        return dense_keys(first, LINE_ORDER, "EmpleadoCapacitacionID", [
            F.col("l_partkey").alias("CapacitacionID"), F.col("o_custkey").alias("EmpleadoID"),
            F.when(~pending, F.col("l_quantity").cast("int") % 41 + 60).cast("decimal(5,2)").alias("CalificacionObtenida"),
            F.when(~pending, F.col("l_shipdate").cast("date")).alias("FechaCompletado"),
            F.when(pending, "En Curso").otherwise("Completada").alias("Estado"),
        ])


def enrolment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their employee: enrolments before repeated pairs are dropped."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, folder, "lineitem").select(*LINE_ORDER, "l_quantity", "l_returnflag")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
