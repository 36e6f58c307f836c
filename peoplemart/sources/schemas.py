"""The eight source tables and the ten mart tables, with the constraints declared on them.

Spark stores no keys or checks, so each constraint is data here and a check operator
(peoplemart.operators.checks) reports the rows that break it. Identifiers are BIGINT: at
cluster scale employees and programmes outnumber a 32-bit integer. NULL satisfies a rule.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _column(name: str, dtype: T.DataType, null: bool, **metadata) -> T.StructField:
    return T.StructField(name, dtype, null, metadata or None)


def ident(name: str, null: bool = False) -> T.StructField:
    return _column(name, T.LongType(), null)


def whole(name: str) -> T.StructField:
    return _column(name, T.IntegerType(), False)


def text(name: str, length: int, null: bool = False) -> T.StructField:
    return _column(name, T.StringType(), null, max_length=length)


def exact(name: str, precision: int, scale: int, null: bool = False) -> T.StructField:
    return _column(name, T.DecimalType(precision, scale), null)


def day(name: str, null: bool = False) -> T.StructField:
    return _column(name, T.DateType(), null)


def flag(name: str) -> T.StructField:
    return _column(name, T.BooleanType(), False)


def moment(name: str) -> T.StructField:
    return _column(name, T.TimestampNTZType(), False)


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: list[T.StructField]
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = ()
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    amounts: tuple[str, ...] = ()   # positive or non-negative numbers
    orders: tuple[str, ...] = ()    # one column not below another
    ranges: tuple[str, ...] = ()    # closed numeric ranges
    pairings: tuple[str, ...] = ()  # columns filled together
    defaults: Mapping[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(self.columns)

    @property
    def key(self) -> str:
        return self.columns[0].name


NOW = object()  # default of audit columns: the load time passed by the caller

SOURCE = {table.name: table for table in [
    Table("Oficinas", [
        ident("OficinaID"), text("CodigoOficina", 20), text("Ciudad", 100), text("Pais", 100),
        text("Region", 100), text("CodigoPostal", 20, True), text("Telefono", 30, True),
        text("Direccion", 200), moment("FechaCreacion"),
    ], unique=(("CodigoOficina",),), defaults={"FechaCreacion": NOW}),
    Table("Departamentos", [
        ident("DepartamentoID"), text("NombreDepartamento", 100), text("Descripcion", 250, True),
        ident("OficinaID"), moment("FechaCreacion"),
    ], unique=(("NombreDepartamento",),),
        references=(Reference("OficinaID", "Oficinas", "OficinaID"),),
        defaults={"FechaCreacion": NOW}),
    Table("Puestos", [
        ident("PuestoID"), text("NombrePuesto", 120), text("NivelSalarial", 20),
        exact("SalarioMinimo", 12, 2), exact("SalarioMaximo", 12, 2), moment("FechaCreacion"),
    ], domains={"NivelSalarial": ("Junior", "Mid-Level", "Senior")},
        amounts=("SalarioMinimo > 0",), orders=("SalarioMaximo >= SalarioMinimo",),
        defaults={"FechaCreacion": NOW}),
    Table("Empleados", [
        ident("EmpleadoID"), text("Identificacion", 30), text("Nombre", 80), text("Apellidos", 120),
        day("FechaNacimiento"), text("Genero", 20), text("EstadoCivil", 30), text("Email", 150),
        text("Telefono", 30, True), day("FechaContratacion"), ident("DepartamentoID"),
        ident("PuestoID"), exact("SalarioActual", 12, 2), ident("JefeID", True),
        ident("OficinaID"), flag("Activo"), moment("FechaCreacion"),
    ], unique=(("Identificacion",), ("Email",)),
        references=(Reference("DepartamentoID", "Departamentos", "DepartamentoID"),
                    Reference("PuestoID", "Puestos", "PuestoID"),
                    Reference("OficinaID", "Oficinas", "OficinaID"),
                    Reference("JefeID", "Empleados", "EmpleadoID")),
        domains={"Genero": ("Masculino", "Femenino", "No Binario", "Otro")},
        amounts=("SalarioActual > 0",),
        defaults={"Activo": True, "FechaCreacion": NOW}),
    Table("Ausencias", [
        ident("AusenciaID"), ident("EmpleadoID"), text("TipoAusencia", 30), day("FechaInicio"),
        day("FechaFin"), whole("DiasTotales"), flag("Justificada"),
        text("Comentarios", 300, True), moment("FechaRegistro"),
    ], references=(Reference("EmpleadoID", "Empleados", "EmpleadoID"),),
        domains={"TipoAusencia": ("Vacaciones", "Enfermedad", "Permiso Personal", "Licencia Médica")},
        orders=("FechaFin >= FechaInicio",), defaults={"FechaRegistro": NOW}),
    Table("EvaluacionesDesempeno", [
        ident("EvaluacionID"), ident("EmpleadoEvaluadoID"), day("FechaEvaluacion"),
        exact("Calificacion", 3, 1), ident("EvaluadorID"), text("Comentarios", 500, True),
        moment("FechaRegistro"),
    ], references=(Reference("EmpleadoEvaluadoID", "Empleados", "EmpleadoID"),
                   Reference("EvaluadorID", "Empleados", "EmpleadoID")),
        ranges=("Calificacion BETWEEN 1.0 AND 5.0",), defaults={"FechaRegistro": NOW}),
    Table("Capacitaciones", [
        ident("CapacitacionID"), text("NombreCapacitacion", 150), text("Descripcion", 300, True),
        text("Proveedor", 150), exact("Costo", 12, 2), day("FechaInicio"), day("FechaFin"),
        whole("DuracionDias"), moment("FechaCreacion"),
    ], amounts=("Costo >= 0",), orders=("FechaFin >= FechaInicio",),
        defaults={"FechaCreacion": NOW}),
    Table("EmpleadosCapacitaciones", [
        ident("EmpleadoCapacitacionID"), ident("EmpleadoID"), ident("CapacitacionID"),
        exact("CalificacionObtenida", 5, 2, True), day("FechaCompletado", True), text("Estado", 20),
        text("Comentarios", 300, True), moment("FechaRegistro"),
    ], unique=(("EmpleadoID", "CapacitacionID"),),
        references=(Reference("EmpleadoID", "Empleados", "EmpleadoID"),
                    Reference("CapacitacionID", "Capacitaciones", "CapacitacionID")),
        domains={"Estado": ("Completada", "En Curso")},
        ranges=("CalificacionObtenida BETWEEN 0 AND 100",),
        pairings=("(Estado = 'Completada') = (CalificacionObtenida IS NOT NULL)",
                  "(Estado = 'Completada') = (FechaCompletado IS NOT NULL)"),
        defaults={"FechaRegistro": NOW}),
]}

_FACT_PLACE = (Reference("EmpleadoKey", "DimEmpleado", "EmpleadoKey"),
               Reference("OficinaKey", "DimOficina", "OficinaKey"),
               Reference("DepartamentoKey", "DimDepartamento", "DepartamentoKey"))
_FACT_DAY = Reference("FechaKey", "DimFecha", "FechaKey")
_FACT_JOB = Reference("PuestoKey", "DimPuesto", "PuestoKey")

MART = {table.name: table for table in [
    Table("DimFecha", [
        whole("FechaKey"), day("FechaCompleta"), whole("Anio"), whole("Semestre"),
        whole("Trimestre"), whole("Mes"), text("NombreMes", 20), whole("Dia"),
        text("NombreDiaSemana", 20),
    ]),
    Table("DimOficina", [
        ident("OficinaKey"), ident("OficinaID_OLTP"), text("CodigoOficina", 20),
        text("Ciudad", 100), text("Pais", 100), text("Region", 100), text("CodigoPostal", 20, True),
    ]),
    Table("DimDepartamento", [
        ident("DepartamentoKey"), ident("DepartamentoID_OLTP"), text("NombreDepartamento", 100),
        text("Descripcion", 250, True),
    ]),
    Table("DimPuesto", [
        ident("PuestoKey"), ident("PuestoID_OLTP"), text("NombrePuesto", 120),
        text("NivelSalarial", 20), exact("SalarioMinimo", 12, 2), exact("SalarioMaximo", 12, 2),
    ]),
    Table("DimEmpleado", [
        ident("EmpleadoKey"), ident("EmpleadoID_OLTP"), text("Identificacion", 30),
        text("NombreCompleto", 220), text("Genero", 20), text("EstadoCivil", 30), whole("Edad"),
        day("FechaContratacion"), whole("AntiguedadAnios"), flag("Activo"),
        ident("DepartamentoID_OLTP"), ident("PuestoID_OLTP"), ident("OficinaID_OLTP"),
        ident("JefeID_OLTP", True),
    ]),
    Table("DimTipoAusencia", [ident("TipoAusenciaKey"), text("TipoAusencia", 30)],
          unique=(("TipoAusencia",),)),
    Table("DimCapacitacion", [
        ident("CapacitacionKey"), ident("CapacitacionID_OLTP"), text("NombreCapacitacion", 150),
        text("Proveedor", 150), exact("Costo", 12, 2), whole("DuracionDias"),
    ]),
    Table("FactAusencias", [
        ident("FactAusenciaKey"), whole("FechaKey"), ident("EmpleadoKey"), ident("OficinaKey"),
        ident("DepartamentoKey"), ident("TipoAusenciaKey"), whole("CantidadAusencias"),
        whole("DiasAusencia"), flag("JustificadaFlag"),
    ], references=(_FACT_DAY, *_FACT_PLACE,
                   Reference("TipoAusenciaKey", "DimTipoAusencia", "TipoAusenciaKey"))),
    Table("FactEvaluaciones", [
        ident("FactEvaluacionKey"), whole("FechaKey"), ident("EmpleadoKey"),
        ident("EvaluadorEmpleadoKey"), ident("OficinaKey"), ident("DepartamentoKey"),
        ident("PuestoKey"), exact("Calificacion", 3, 1), whole("CantidadEvaluaciones"),
    ], references=(_FACT_DAY, *_FACT_PLACE, _FACT_JOB,
                   Reference("EvaluadorEmpleadoKey", "DimEmpleado", "EmpleadoKey"))),
    Table("FactCapacitaciones", [
        ident("FactCapacitacionKey"), whole("FechaKey"), ident("EmpleadoKey"),
        ident("CapacitacionKey"), ident("OficinaKey"), ident("DepartamentoKey"), ident("PuestoKey"),
        text("Estado", 20), exact("CalificacionObtenida", 5, 2, True),
        whole("CantidadAsignaciones"), exact("CostoCapacitacion", 12, 2),
    ], references=(_FACT_DAY, *_FACT_PLACE, _FACT_JOB,
                   Reference("CapacitacionKey", "DimCapacitacion", "CapacitacionKey"))),
]}


def conformed(df: DataFrame, table: Table, now: Column) -> DataFrame:
    """df with exactly the declared columns and types, missing values set to their defaults."""
    def value(spec: T.StructField) -> Column:
        given = F.col(spec.name) if spec.name in df.columns else F.lit(None)
        if spec.name in table.defaults:
            default = table.defaults[spec.name]
            given = F.coalesce(given, now if default is NOW else F.lit(default))
        return given.cast(spec.dataType).alias(spec.name)

    return df.select([value(spec) for spec in table.columns])
