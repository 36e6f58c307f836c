"""The same results in SQL for a second engine (DuckDB), one statement per registered query.

Every statement starts with the source tables and the mart as common table expressions over
the test tables. Joins, aggregates and rounding (integers only) are written without the Spark plans;
the declared constraints, labels, report texts, month names and the role map's dates come from the package.
"""

from __future__ import annotations

from collections.abc import Callable

from peoplemart.functions.dates import MONTH_NAMES, WEEKDAY_NAMES
from peoplemart.plans import kpis
from peoplemart.plans.quality import CHECKS
from peoplemart.sources.roles import AS_OF, CALENDAR_END, CALENDAR_START
from peoplemart.sources.schemas import MART, SOURCE, Table

NARROW = ("1996-01-01", "2000-12-31")


def _names(names: list[str]) -> str:
    return "[" + ", ".join(f"'{name}'" for name in names) + "]"


def _calendar(start: str, end: str, language: str = "es") -> str:
    return f"""
    SELECT CAST(year(f) * 10000 + month(f) * 100 + day(f) AS BIGINT) AS FechaKey, f AS FechaCompleta,
           CAST(year(f) AS BIGINT) AS Anio, CAST(CASE WHEN month(f) <= 6 THEN 1 ELSE 2 END AS BIGINT) AS Semestre,
           CAST(quarter(f) AS BIGINT) AS Trimestre, CAST(month(f) AS BIGINT) AS Mes,
           {_names(MONTH_NAMES[language])}[month(f)] AS NombreMes, CAST(day(f) AS BIGINT) AS Dia,
           {_names(WEEKDAY_NAMES[language])}[dayofweek(f) + 1] AS NombreDiaSemana
    FROM (SELECT CAST(d AS DATE) AS f
          FROM generate_series({start}, {end}, INTERVAL 1 DAY) AS days(d))"""


def _ctes(start: str = str(CALENDAR_START), end: str = str(CALENDAR_END)) -> str:
    today = f"DATE '{AS_OF}'"
    now = f"TIMESTAMP '{AS_OF} 00:00:00'"
    none = "CAST(NULL AS VARCHAR)"
    tables = {
        "lines": """
    SELECT o_custkey, l.*, row_number() OVER (
               PARTITION BY o_custkey, l_partkey
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice) AS rep
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey""",
        "Oficinas": f"""
    SELECT n_nationkey AS OficinaID, r_name || '-' || n_nationkey AS CodigoOficina, n_name AS Ciudad,
           n_name AS Pais, r_name AS Region, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS CodigoPostal,
           {none} AS Telefono, n_name || ', ' || r_name AS Direccion, {now} AS FechaCreacion
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "segments": """
    SELECT row_number() OVER (ORDER BY c_mktsegment) AS DepartamentoID, c_mktsegment,
           min(c_custkey) AS HeadID, min(c_nationkey) AS OficinaID
    FROM customer GROUP BY c_mktsegment""",
        "Departamentos": f"""
    SELECT DepartamentoID, c_mktsegment AS NombreDepartamento, 'Area ' || c_mktsegment AS Descripcion,
           OficinaID, {now} AS FechaCreacion FROM segments""",
        "Puestos": f"""
    SELECT *, CASE PuestoID % 3 WHEN 0 THEN 'Senior' WHEN 1 THEN 'Junior' ELSE 'Mid-Level' END AS NivelSalarial,
           {now} AS FechaCreacion
    FROM (SELECT row_number() OVER (ORDER BY p_type) AS PuestoID, p_type AS NombrePuesto,
                 CAST(min(p_retailprice) AS DECIMAL(12,2)) AS SalarioMinimo,
                 CAST(max(p_retailprice) AS DECIMAL(12,2)) AS SalarioMaximo
          FROM part GROUP BY p_type)""",
        "Empleados": f"""
    SELECT c_custkey AS EmpleadoID, 'EMP-' || c_custkey AS Identificacion,
           split_part(c_name, '#', 1) AS Nombre, split_part(c_name, '#', 2) AS Apellidos,
           DATE '1950-01-01' + CAST(c_custkey * 41 % 9000 AS INTEGER) AS FechaNacimiento,
           CASE c_custkey % 4 WHEN 0 THEN 'Masculino' WHEN 1 THEN 'Femenino' WHEN 2 THEN 'No Binario'
                ELSE 'Otro' END AS Genero,
           CASE WHEN c_custkey % 3 = 0 THEN 'Casado(a)' ELSE 'Soltero(a)' END AS EstadoCivil,
           'empleado' || c_custkey || '@example.org' AS Email, {none} AS Telefono,
           DATE '1990-01-01' + CAST(c_custkey * 37 % 4190 AS INTEGER) AS FechaContratacion,
           DepartamentoID, c_custkey % 6 + 1 AS PuestoID,
           CAST(c_acctbal AS DECIMAL(12,2)) + 10000 AS SalarioActual,
           CASE WHEN c_custkey <> HeadID THEN HeadID END AS JefeID,
           c_nationkey AS OficinaID, c_acctbal >= 0 AS Activo, {now} AS FechaCreacion
    FROM customer JOIN segments USING (c_mktsegment)""",
        "Ausencias": f"""
    SELECT o_orderkey AS AusenciaID, o_custkey AS EmpleadoID, o_orderpriority AS TipoAusencia,
           CAST(o_orderdate AS DATE) AS FechaInicio,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INTEGER) AS FechaFin,
           CAST(o_orderkey % 6 + 1 AS BIGINT) AS DiasTotales, o_orderstatus <> 'F' AS Justificada,
           {none} AS Comentarios, {now} AS FechaRegistro
    FROM orders""",
        "EvaluacionesDesempeno": f"""
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice) AS EvaluacionID, o_custkey AS EmpleadoEvaluadoID,
           CAST(l_shipdate AS DATE) AS FechaEvaluacion,
           10 + CAST(l_quantity AS INTEGER) % 41 AS tenths, (10 + CAST(l_quantity AS INTEGER) % 41) / 10.0 AS Calificacion,
           HeadID AS EvaluadorID, {none} AS Comentarios, {now} AS FechaRegistro
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN segments USING (c_mktsegment)""",
        "Capacitaciones": f"""
    SELECT p_partkey AS CapacitacionID, p_name AS NombreCapacitacion, {none} AS Descripcion,
           p_brand AS Proveedor, CAST(p_retailprice AS DECIMAL(12,2)) AS Costo,
           DATE '1995-01-01' + CAST(p_partkey % 2000 AS INTEGER) AS FechaInicio,
           DATE '1995-01-01' + CAST(p_partkey % 2000 + p_size - 1 AS INTEGER) AS FechaFin,
           CAST(p_size AS BIGINT) AS DuracionDias, {now} AS FechaCreacion
    FROM part""",
        "EmpleadosCapacitaciones": f"""
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice) AS EmpleadoCapacitacionID, o_custkey AS EmpleadoID, l_partkey AS CapacitacionID,
           CASE WHEN l_returnflag <> 'N' THEN 60 + CAST(l_quantity AS INTEGER) % 41 END AS CalificacionObtenida,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS FechaCompletado,
           CASE WHEN l_returnflag = 'N' THEN 'En Curso' ELSE 'Completada' END AS Estado,
           {none} AS Comentarios, {now} AS FechaRegistro
    FROM lines WHERE rep = 1""",
        "DimFecha": _calendar(f"DATE '{start}'", f"DATE '{end}'"),
        "DimOficina": """
    SELECT row_number() OVER (ORDER BY OficinaID) AS OficinaKey, OficinaID AS OficinaID_OLTP, CodigoOficina,
           Ciudad, Pais, Region, CodigoPostal FROM Oficinas""",
        "DimDepartamento": """
    SELECT row_number() OVER (ORDER BY DepartamentoID) AS DepartamentoKey, DepartamentoID AS DepartamentoID_OLTP,
           NombreDepartamento, Descripcion FROM Departamentos""",
        "DimPuesto": """
    SELECT row_number() OVER (ORDER BY PuestoID) AS PuestoKey, PuestoID AS PuestoID_OLTP, NombrePuesto,
           NivelSalarial, SalarioMinimo, SalarioMaximo FROM Puestos""",
        "DimEmpleado": f"""
    SELECT row_number() OVER (ORDER BY EmpleadoID) AS EmpleadoKey, EmpleadoID AS EmpleadoID_OLTP, Identificacion,
           Nombre || ' ' || Apellidos AS NombreCompleto, Genero, EstadoCivil,
           CAST(year({today}) - year(FechaNacimiento)
                - CASE WHEN strftime(FechaNacimiento, '%m%d') > strftime({today}, '%m%d') THEN 1 ELSE 0 END
                AS BIGINT) AS Edad,
           FechaContratacion, CAST(year({today}) - year(FechaContratacion) AS BIGINT) AS AntiguedadAnios, Activo,
           DepartamentoID AS DepartamentoID_OLTP, PuestoID AS PuestoID_OLTP, OficinaID AS OficinaID_OLTP,
           JefeID AS JefeID_OLTP
    FROM Empleados""",
        "DimTipoAusencia": """
    SELECT row_number() OVER (ORDER BY TipoAusencia) AS TipoAusenciaKey, TipoAusencia
    FROM (SELECT DISTINCT TipoAusencia FROM Ausencias)""",
        "DimCapacitacion": """
    SELECT row_number() OVER (ORDER BY CapacitacionID) AS CapacitacionKey, CapacitacionID AS CapacitacionID_OLTP,
           NombreCapacitacion, Proveedor, Costo, DuracionDias FROM Capacitaciones""",
        "places": """
    SELECT EmpleadoID_OLTP, EmpleadoKey, OficinaKey, DepartamentoKey, PuestoKey
    FROM DimEmpleado JOIN DimOficina USING (OficinaID_OLTP) JOIN DimDepartamento USING (DepartamentoID_OLTP)
    LEFT JOIN DimPuesto USING (PuestoID_OLTP)""",
        "FactAusencias": """
    SELECT AusenciaID AS FactAusenciaKey, CAST(strftime(FechaInicio, '%Y%m%d') AS BIGINT) AS FechaKey,
           EmpleadoKey, OficinaKey, DepartamentoKey, TipoAusenciaKey, CAST(1 AS BIGINT) AS CantidadAusencias,
           DiasTotales AS DiasAusencia, Justificada AS JustificadaFlag
    FROM Ausencias JOIN places ON EmpleadoID = EmpleadoID_OLTP JOIN DimTipoAusencia USING (TipoAusencia)""",
        "FactEvaluaciones": """
    SELECT EvaluacionID AS FactEvaluacionKey, CAST(strftime(FechaEvaluacion, '%Y%m%d') AS BIGINT) AS FechaKey,
           p.EmpleadoKey, r.EmpleadoKey AS EvaluadorEmpleadoKey, OficinaKey, DepartamentoKey, PuestoKey,
           tenths, Calificacion, CAST(1 AS BIGINT) AS CantidadEvaluaciones
    FROM EvaluacionesDesempeno JOIN places p ON EmpleadoEvaluadoID = p.EmpleadoID_OLTP
    JOIN DimEmpleado r ON EvaluadorID = r.EmpleadoID_OLTP
    WHERE PuestoKey IS NOT NULL""",
        "FactCapacitaciones": """
    SELECT EmpleadoCapacitacionID AS FactCapacitacionKey,
           CAST(strftime(coalesce(FechaCompletado, FechaInicio), '%Y%m%d') AS BIGINT) AS FechaKey,
           EmpleadoKey, CapacitacionKey, OficinaKey, DepartamentoKey, PuestoKey, Estado, CalificacionObtenida,
           CAST(1 AS BIGINT) AS CantidadAsignaciones, c.Costo AS CostoCapacitacion,
           CAST(c.Costo * 100 AS BIGINT) AS cents
    FROM EmpleadosCapacitaciones JOIN Capacitaciones c USING (CapacitacionID)
    JOIN DimCapacitacion ON CapacitacionID = CapacitacionID_OLTP
    JOIN places ON EmpleadoID = EmpleadoID_OLTP
    WHERE PuestoKey IS NOT NULL""",
    }
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in tables.items()) + "\n"


def _ratio(top: str, bottom: str, digits: int) -> str:
    """top / bottom rounded half up at `digits` decimals, for integers that are not negative."""
    a, b, unit = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)", 10**digits
    return f"CAST((2 * {a} * {unit} + {b}) // nullif(2 * {b}, 0) AS DOUBLE) / {unit}.0"


def _percent(part: str, whole: str, digits: int) -> str:
    return _ratio(f"100 * ({part})", whole, digits)


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100.0"


_BANDS = ", ".join(f"count(*) FILTER (WHERE {condition}) AS {name}" for name, condition in {
    "Excelente": "tenths >= 45", "Bueno": "tenths BETWEEN 35 AND 44",
    "Regular": "tenths BETWEEN 25 AND 34", "Deficiente": "tenths < 25"}.items())

_FA = "FactAusencias JOIN DimDepartamento USING (DepartamentoKey)"
_FE = "FactEvaluaciones JOIN DimDepartamento USING (DepartamentoKey)"
_FC = "FactCapacitaciones JOIN DimDepartamento USING (DepartamentoKey)"
_FA_PERSON = f"""{_FA} JOIN DimEmpleado USING (EmpleadoKey) JOIN DimOficina USING (OficinaKey)"""
_LOST = "coalesce(sum(DiasAusencia) FILTER (WHERE NOT JustificadaFlag), 0)"


def _rate(where: str = "") -> str:
    lost, available = "sum(DiasAusencia)", f"count(DISTINCT EmpleadoKey) * {kpis.WORKING_DAYS}"
    return f"""
    SELECT NombreDepartamento, count(DISTINCT EmpleadoKey) AS TotalEmpleados, {_big(lost)} AS TotalDiasAusentes,
           {_big(available)} AS DiasLaborablesDisponibles, {_percent(lost, available, 2)} AS TasaAusentismoPct,
           CASE WHEN {lost} * 100 > 5 * {available} THEN '{kpis.RISK_CRITICAL}'
                WHEN {lost} * 100 > 3 * {available} THEN '{kpis.RISK_ELEVATED}'
                ELSE '{kpis.RISK_NORMAL}' END AS NivelRiesgo
    FROM {_FA} {where} GROUP BY NombreDepartamento"""


def _top_absent(person: str) -> str:
    return f"""
    SELECT {person}NombreCompleto, NombreDepartamento, Ciudad AS Oficina, count(*) AS CantidadEventos,
           {_big("sum(DiasAusencia)")} AS TotalDiasAusentes,
           {_big(f"sum(DiasAusencia) - {_LOST}")} AS DiasJustificados, {_big(_LOST)} AS DiasNoJustificados,
           {_percent(_LOST, "sum(DiasAusencia)", 1)} AS PctNoJustificado
    FROM {_FA_PERSON} GROUP BY {person}NombreCompleto, NombreDepartamento, Ciudad
    ORDER BY sum(DiasAusencia) DESC, NombreCompleto, NombreDepartamento, Ciudad LIMIT 10"""


def _best_rated(person: str) -> str:
    return f"""
    SELECT NombreDepartamento, Ranking, {person}NombreCompleto, {_ratio("total", "10 * n", 1)} AS PromedioCalif,
           n AS TotalEvaluaciones
    FROM (SELECT NombreDepartamento, {person}NombreCompleto, sum(tenths) AS total, count(*) AS n,
                 rank() OVER (PARTITION BY NombreDepartamento
                              ORDER BY CAST(sum(tenths) AS HUGEINT) * 10000000000000000 // count(*) DESC) AS Ranking
          FROM {_FE} JOIN DimEmpleado USING (EmpleadoKey)
          GROUP BY NombreDepartamento, {person}NombreCompleto)
    WHERE Ranking <= 3"""


def _alerts(person: str) -> str:
    return f"""
    SELECT {person}NombreCompleto, NombreDepartamento, Ciudad AS Oficina,
           count(*) FILTER (WHERE NOT JustificadaFlag) AS AusenciasNoJust, {_big(_LOST)} AS DiasNoJust,
           {_big("sum(DiasAusencia)")} AS TotalDias, {_percent(_LOST, "sum(DiasAusencia)", 1)} AS PctNoJustificado,
           CASE WHEN count(*) FILTER (WHERE NOT JustificadaFlag) >= 3 THEN '{kpis.ALERT_HIGH}'
                WHEN count(*) FILTER (WHERE NOT JustificadaFlag) = 2 THEN '{kpis.ALERT_MEDIUM}'
                ELSE '{kpis.ALERT_FOLLOW_UP}' END AS NivelAlerta
    FROM {_FA_PERSON} GROUP BY {person}NombreCompleto, NombreDepartamento, Ciudad
    HAVING count(*) FILTER (WHERE NOT JustificadaFlag) > 0"""


def _kpi_sql() -> dict[str, str]:
    deviation = """
        CAST(floor(sqrt(CAST(count(*) * CAST(sum(tenths * tenths) AS HUGEINT)
                             - CAST(sum(tenths) AS HUGEINT) * sum(tenths) AS DOUBLE)
                        / nullif(CAST(count(*) * (count(*) - 1) AS DOUBLE), 0.0)) * 100.0 + 0.5) AS DOUBLE) / 1000.0"""
    completed = "count(*) FILTER (WHERE Estado = 'Completada')"
    grades = "sum(CalificacionObtenida)"
    return {
        "q01": f"""
    SELECT NombreDepartamento, TipoAusencia, count(*) AS CantidadEventos,
           {_big("sum(DiasAusencia)")} AS TotalDiasAusentes,
           {_ratio("sum(DiasAusencia)", "count(*)", 2)} AS PromedioDiasPorEvento,
           count(*) FILTER (WHERE JustificadaFlag) AS Justificadas,
           count(*) FILTER (WHERE NOT JustificadaFlag) AS NoJustificadas,
           {_percent("count(*) FILTER (WHERE JustificadaFlag)", "count(*)", 1)} AS PctJustificado
    FROM {_FA} JOIN DimTipoAusencia USING (TipoAusenciaKey) GROUP BY NombreDepartamento, TipoAusencia""",
        "q02": f"""
    SELECT NombreDepartamento, count(*) AS TotalEvaluaciones,
           {_ratio("sum(tenths)", "10 * count(*)", 1)} AS PromedioCalificacion,
           min(tenths) / 10.0 AS Minima, max(tenths) / 10.0 AS Maxima,
           {deviation} AS DesviacionEstandar, {_BANDS}
    FROM {_FE} GROUP BY NombreDepartamento""",
        "q03": f"""
    SELECT Anio, Mes, NombreMes, count(*) AS CantidadEventos, {_big("sum(DiasAusencia)")} AS TotalDiasAusentes,
           count(DISTINCT EmpleadoKey) AS EmpleadosAfectados,
           {_ratio("sum(DiasAusencia)", "count(DISTINCT EmpleadoKey)", 2)} AS DiasPromPorEmpleado
    FROM FactAusencias JOIN DimFecha USING (FechaKey) GROUP BY Anio, Mes, NombreMes""",
        "q04": _top_absent(""),
        "q04_bucketed": _top_absent(""),
        "q04_by_key": _top_absent("EmpleadoID_OLTP, "),
        "q05": f"""
    SELECT NombreDepartamento, Estado, count(*) AS Asignaciones, count(DISTINCT EmpleadoKey) AS EmpleadosParticipantes,
           {_money("sum(cents)")} AS InversionTotal,
           {_ratio("sum(cents)", "100 * count(DISTINCT EmpleadoKey)", 2)} AS CostoPorEmpleado,
           {_ratio(grades, "count(CalificacionObtenida)", 1)} AS CalificacionPromedio
    FROM {_FC} GROUP BY NombreDepartamento, Estado""",
        "q06": f"""
    SELECT NombreDepartamento, count(*) AS TotalActivos,
           count(*) FILTER (WHERE AntiguedadAnios < 1) AS MenosDeUnAnio,
           count(*) FILTER (WHERE AntiguedadAnios BETWEEN 1 AND 3) AS De1a3Anios,
           count(*) FILTER (WHERE AntiguedadAnios BETWEEN 4 AND 7) AS De4a7Anios,
           count(*) FILTER (WHERE AntiguedadAnios > 7) AS MasDe7Anios,
           {_ratio("sum(AntiguedadAnios)", "count(*)", 1)} AS AntiguedadPromedio
    FROM DimEmpleado JOIN DimDepartamento USING (DepartamentoID_OLTP) WHERE Activo GROUP BY NombreDepartamento""",
        "q07": _rate(),
        "q07_1998": _rate("JOIN DimFecha USING (FechaKey) WHERE Anio = 1998"),
        "q07_1998_1999": _rate("JOIN DimFecha USING (FechaKey) WHERE Anio BETWEEN 1998 AND 1999"),
        "q08": f"""
    SELECT Ciudad, Pais, Region, count(DISTINCT EmpleadoKey) AS EmpleadosCapacitados, count(*) AS TotalAsignaciones,
           {_money("sum(cents)")} AS InversionTotal,
           {_ratio("sum(cents)", "100 * count(*)", 2)} AS CostoPromPorAsignacion,
           {_ratio("sum(cents)", "100 * count(DISTINCT EmpleadoKey)", 2)} AS InversionPorEmpleado
    FROM FactCapacitaciones JOIN DimOficina USING (OficinaKey) GROUP BY Ciudad, Pais, Region""",
        "q09": f"""
    SELECT Anio, Trimestre, 'Q' || Trimestre || '-' || Anio AS Periodo, count(*) AS TotalEvaluaciones,
           {_ratio("sum(tenths)", "10 * count(*)", 1)} AS PromedioCalificacion, {_BANDS}
    FROM FactEvaluaciones JOIN DimFecha USING (FechaKey) GROUP BY Anio, Trimestre""",
        "q10": f"""
    SELECT NombreDepartamento, Genero, n AS CantidadEmpleados,
           {_percent("n", "sum(n) OVER (PARTITION BY NombreDepartamento)", 1)} AS PctEnDepartamento
    FROM (SELECT NombreDepartamento, Genero, count(*) AS n
          FROM DimEmpleado JOIN DimDepartamento USING (DepartamentoID_OLTP) WHERE Activo
          GROUP BY NombreDepartamento, Genero)""",
        "q11": _best_rated(""),
        "q11_by_key": _best_rated("EmpleadoID_OLTP, "),
        "q12": f"""
    SELECT NombreCapacitacion, Proveedor, DuracionDias, count(*) AS VecesAsignada,
           {_money("sum(cents)")} AS InversionTotal,
           {_ratio(grades, "count(CalificacionObtenida)", 1)} AS CalifPromedioObtenida,
           {_percent(completed, "count(*)", 1)} AS TasaCompletitudPct, {completed} AS Completadas,
           count(*) FILTER (WHERE Estado = 'En Curso') AS EnCurso
    FROM FactCapacitaciones JOIN DimCapacitacion USING (CapacitacionKey)
    GROUP BY NombreCapacitacion, Proveedor, DuracionDias""",
        "q13": _alerts(""),
        "q13_bucketed": _alerts(""),
        "q13_by_key": _alerts("EmpleadoID_OLTP, "),
        "q14": f"""
    SELECT a.Anio, EmpleadosConAusencias, TotalDiasAusentes, DiasPromPorEvento, PromedioDesempeno,
           InversionCapacitacion, coalesce(done, 0) AS CapacitacionesCompletadas
    FROM (SELECT Anio, count(DISTINCT EmpleadoKey) AS EmpleadosConAusencias,
                 {_big("sum(DiasAusencia)")} AS TotalDiasAusentes,
                 {_ratio("sum(DiasAusencia)", "count(*)", 2)} AS DiasPromPorEvento
          FROM FactAusencias JOIN DimFecha USING (FechaKey) GROUP BY Anio) a
    LEFT JOIN (SELECT Anio, {_ratio("sum(tenths)", "10 * count(*)", 1)} AS PromedioDesempeno
               FROM FactEvaluaciones JOIN DimFecha USING (FechaKey) GROUP BY Anio) e USING (Anio)
    LEFT JOIN (SELECT Anio, {_money("sum(cents)")} AS InversionCapacitacion, {completed} AS done
               FROM FactCapacitaciones JOIN DimFecha USING (FechaKey) GROUP BY Anio) c USING (Anio)""",
        "q15": f"""
    SELECT Ciudad, Pais, Region, HeadcountActivo, AntiguedadPromedio, DesempenoPromedio,
           TotalDiasAusentes, InversionCapacitacion, TasaCompletitudCapPct
    FROM (SELECT OficinaKey, Ciudad, Pais, Region, count(*) AS HeadcountActivo,
                 {_ratio("sum(AntiguedadAnios)", "count(*)", 1)} AS AntiguedadPromedio
          FROM DimEmpleado JOIN DimOficina USING (OficinaID_OLTP) WHERE Activo
          GROUP BY OficinaKey, Ciudad, Pais, Region) o
    LEFT JOIN (SELECT OficinaKey, {_ratio("sum(tenths)", "10 * count(*)", 1)} AS DesempenoPromedio
               FROM FactEvaluaciones GROUP BY OficinaKey) e USING (OficinaKey)
    LEFT JOIN (SELECT OficinaKey, {_big("sum(DiasAusencia)")} AS TotalDiasAusentes
               FROM FactAusencias GROUP BY OficinaKey) a USING (OficinaKey)
    LEFT JOIN (SELECT OficinaKey, {_money("sum(cents)")} AS InversionCapacitacion,
                      {_percent(completed, "count(*)", 1)} AS TasaCompletitudCapPct
               FROM FactCapacitaciones GROUP BY OficinaKey) c USING (OficinaKey)""",
    }


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


def _counts(tables: list[str], kind: bool) -> str:
    def one(name: str) -> str:
        label = f", '{'Dimensión' if name.startswith('Dim') else 'Hecho'}' AS Tipo" if kind else ""
        return f"SELECT '{name}' AS Tabla{label}, count(*) AS Registros FROM {name}"
    return " UNION ALL ".join(map(one, tables))


def _load_sql() -> dict[str, str]:
    dates = """(SELECT CAST(o_orderdate AS DATE) AS d FROM orders
                UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)"""
    first = f"(SELECT make_date(year(min(d)), 1, 1) FROM {dates})"
    last = f"(SELECT make_date(year(max(d)), 12, 31) FROM {dates})"
    place = """JOIN DimEmpleado USING (EmpleadoKey) JOIN DimOficina USING (OficinaKey)
               JOIN DimDepartamento USING (DepartamentoKey)"""
    employee = f"""EmpleadoKey, EmpleadoID_OLTP, Identificacion, NombreCompleto, Genero, EstadoCivil, Edad,
           {_text("FechaContratacion")}, AntiguedadAnios, Activo, DepartamentoID_OLTP, PuestoID_OLTP,
           {_big("OficinaID_OLTP")} AS OficinaID_OLTP, CAST(JefeID_OLTP AS DOUBLE) AS JefeID_OLTP"""

    def calendar(language: str) -> str:
        return f"""SELECT * REPLACE (CAST(FechaCompleta AS VARCHAR) AS FechaCompleta)
                   FROM ({_calendar(first, last, language)})"""

    return {
        "e01_calendar": calendar("es"),
        "e01_calendar_en": calendar("en"),
        "e02_dim_office": f"""SELECT OficinaKey, {_big("OficinaID_OLTP")} AS OficinaID_OLTP, CodigoOficina, Ciudad, Pais, Region,
                              CodigoPostal FROM DimOficina""",
        "e02_dim_department": "SELECT DepartamentoKey, DepartamentoID_OLTP, NombreDepartamento, Descripcion FROM DimDepartamento",
        "e02_dim_job": """SELECT PuestoKey, PuestoID_OLTP, NombrePuesto, NivelSalarial, CAST(SalarioMinimo AS DOUBLE) AS SalarioMinimo,
                          CAST(SalarioMaximo AS DOUBLE) AS SalarioMaximo FROM DimPuesto""",
        "e02_dim_training": """SELECT CapacitacionKey, CapacitacionID_OLTP, NombreCapacitacion, Proveedor, CAST(Costo AS DOUBLE) AS Costo,
                               DuracionDias FROM DimCapacitacion""",
        "e03_keys": "SELECT EmpleadoKey, EmpleadoID_OLTP FROM DimEmpleado",
        "e03_keys_large": """SELECT row_number() OVER (ORDER BY o_orderkey) AS AusenciaKey, o_orderkey AS AusenciaID
                             FROM orders""",
        "e04_dim_employee": f"SELECT {employee} FROM DimEmpleado",
        "e04_dim_employee_full_years": f"""
    SELECT EmpleadoID_OLTP, NombreCompleto,
           CAST(year(DATE '{AS_OF}') - year(FechaContratacion)
                - CASE WHEN strftime(FechaContratacion, '%m%d') > strftime(DATE '{AS_OF}', '%m%d') THEN 1 ELSE 0 END
                AS BIGINT) AS AntiguedadAnios
    FROM DimEmpleado""",
        "e05_age": """SELECT EmpleadoID_OLTP, CAST(FechaNacimiento AS VARCHAR) AS FechaNacimiento, Edad
                      FROM DimEmpleado JOIN Empleados ON EmpleadoID = EmpleadoID_OLTP""",
        "e06_dim_absence_type": "SELECT * FROM DimTipoAusencia",
        "e07_fact_absence": f"""
    SELECT FactAusenciaKey, FechaKey, EmpleadoID_OLTP, CodigoOficina, NombreDepartamento, TipoAusencia, CantidadAusencias,
           DiasAusencia, JustificadaFlag
    FROM FactAusencias {place} JOIN DimTipoAusencia USING (TipoAusenciaKey)""",
        "e08_fact_review": f"""
    SELECT FactEvaluacionKey, FechaKey, DimEmpleado.EmpleadoID_OLTP, r.EmpleadoID_OLTP AS EvaluadorID_OLTP, CodigoOficina,
           NombreDepartamento, NombrePuesto, tenths / 10.0 AS Calificacion, CantidadEvaluaciones
    FROM FactEvaluaciones {place} JOIN DimPuesto USING (PuestoKey)
    JOIN DimEmpleado r ON r.EmpleadoKey = EvaluadorEmpleadoKey""",
        "e09_fact_training": f"""
    SELECT FactCapacitacionKey, FechaKey, EmpleadoID_OLTP, CapacitacionID_OLTP, CodigoOficina, NombreDepartamento, NombrePuesto, Estado,
           CAST(CalificacionObtenida AS DOUBLE) AS CalificacionObtenida, CantidadAsignaciones,
           CAST(CostoCapacitacion AS DOUBLE) AS CostoCapacitacion
    FROM FactCapacitaciones {place} JOIN DimPuesto USING (PuestoKey) JOIN DimCapacitacion USING (CapacitacionKey)""",
        "e11_counts": _counts(list(MART), True),
        "e11_source_counts": _counts(list(SOURCE), False),
        "s02_catalog_names": """
    SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
        "s07_append": "SELECT o_orderkey, o_custkey, year(o_orderdate) AS year FROM orders",
        "s03_dump": "SELECT * FROM FactAusencias",
        "s05_sequence": "SELECT unnest(generate_series(1, (SELECT count(*) FROM customer))) AS n",
        "s10_load_audit": _counts(list(MART), False),
        "g01_round_robin": """
    SELECT n, o_orderkey, c_custkey
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)
    JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer)
      ON rn = (n - 1) % (SELECT count(*) FROM customer) + 1""",
        "g02_distinct_pairs": """
    SELECT o_custkey, l_partkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_extendedprice, l_quantity, l_returnflag
    FROM lines WHERE rep = 1""",
        "g04_manager": """
    SELECT c_custkey, c_mktsegment, CAST(CASE WHEN c_custkey <> head THEN head END AS DOUBLE) AS JefeID
    FROM customer JOIN (SELECT c_mktsegment, min(c_custkey) AS head FROM customer GROUP BY c_mktsegment)
    USING (c_mktsegment)""",
    }


Names = Callable[[str], str]  # what a table is called in a statement


def _unresolved(fact: str, of: Names) -> str:
    missing = " OR ".join(
        f"{r.column} IS NULL OR {r.column} NOT IN (SELECT {r.parent_column} FROM {of(r.parent)})"
        for r in MART[fact].references)
    return f"SELECT count(*) AS n FROM {of(fact)} WHERE {missing}"


def _count_verdict(number: int, problems: str) -> str:
    check = CHECKS[number]
    return f"""
    SELECT CAST({number} AS BIGINT) AS Num, '{check.category}' AS Categoria, '{check.name}' AS Nombre,
           CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS Estado,
           CASE WHEN n = 0 THEN '{check.passed}' ELSE n || '{check.failed}' END AS Detalle, n AS Problemas
    FROM ({problems})"""


def _match_verdict(number: int, origin: str, fact: str) -> str:
    check = CHECKS[number]
    return f"""
    SELECT CAST({number} AS BIGINT) AS Num, '{check.category}' AS Categoria, '{check.name}' AS Nombre,
           CASE WHEN a = b THEN 'PASS' ELSE 'FAIL' END AS Estado,
           'OLTP=' || a || ' | DWH=' || b || ' | Diferencia=' || abs(a - b) AS Detalle, abs(a - b) AS Problemas
    FROM (SELECT (SELECT count(*) FROM {origin}) AS a, (SELECT count(*) FROM {fact}) AS b)"""


def _calendar_verdict(of: Names) -> str:
    check, start, end = CHECKS[12], CALENDAR_START, CALENDAR_END
    return f"""
    SELECT CAST(12 AS BIGINT) AS Num, '{check.category}' AS Categoria, '{check.name.format(start=start, end=end)}' AS Nombre,
           CASE WHEN a <= DATE '{start}' AND b >= DATE '{end}' THEN 'PASS' ELSE 'FAIL' END AS Estado,
           'Rango real: ' || a || ' a ' || b AS Detalle, CAST(0 AS BIGINT) AS Problemas
    FROM (SELECT min(FechaCompleta) AS a, max(FechaCompleta) AS b FROM {of("DimFecha")})"""


def _verdict_sql(of: Names = str) -> dict[int, str]:
    def rows(table: str, condition: str) -> str:
        return f"SELECT count(*) AS n FROM {of(table)} WHERE {condition}"

    return {
        1: _count_verdict(1, _unresolved("FactAusencias", of)),
        2: _count_verdict(2, _unresolved("FactEvaluaciones", of)),
        3: _count_verdict(3, _unresolved("FactCapacitaciones", of)),
        4: _count_verdict(4, rows("DimEmpleado", """NombreCompleto IS NULL OR Genero IS NULL
            OR Identificacion IS NULL OR FechaContratacion IS NULL""")),
        5: _count_verdict(5, rows("FactEvaluaciones", "tenths < 10 OR tenths > 50")),
        6: _count_verdict(6, rows("FactAusencias", "DiasAusencia <= 0")),
        7: _count_verdict(7, f"""SELECT count(*) AS n FROM (
            SELECT EmpleadoID_OLTP FROM {of("DimEmpleado")} GROUP BY EmpleadoID_OLTP HAVING count(*) > 1)"""),
        8: _match_verdict(8, of("Ausencias"), of("FactAusencias")),
        9: _match_verdict(9, of("EvaluacionesDesempeno"), of("FactEvaluaciones")),
        10: _count_verdict(10, rows("DimEmpleado", "Activo AND DepartamentoID_OLTP IS NULL")),
        11: _count_verdict(11, rows("FactCapacitaciones", "CostoCapacitacion < 0")),
        12: _calendar_verdict(of),
        13: _count_verdict(13, rows("DimEmpleado", "AntiguedadAnios < 0")),
        14: _match_verdict(14, of("EmpleadosCapacitaciones"), of("FactCapacitaciones")),
    }


def _problems(table: str, label: str, count: str) -> str:
    label = label.replace("'", "''")
    return f"SELECT '{table}' AS Tabla, '{label}' AS Restriccion, CAST(({count}) AS BIGINT) AS Problemas"


def _repeats(columns: str, source: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {columns} HAVING count(*) > 1)"


def _key_problems(spec: Table, of: Names) -> str:
    key = spec.key
    count = f"({_repeats(key, of(spec.name))}) + (SELECT count(*) FROM {of(spec.name)} WHERE {key} IS NULL)"
    return _problems(spec.name, f"PRIMARY KEY ({key})", f"SELECT {count}")


def _unique_problems(composite: bool, of: Names) -> list[str]:
    return [_problems(spec.name, f"UNIQUE ({', '.join(columns)})", _repeats(", ".join(columns), of(spec.name)))
            for spec in (*SOURCE.values(), *MART.values()) for columns in spec.unique
            if (len(columns) > 1) == composite]


def _reference_problems(specs: dict[str, Table], to_itself: bool, of: Names) -> list[str]:
    return [
        _problems(spec.name, f"FOREIGN KEY ({r.column}) REFERENCES {r.parent}", f"""
            SELECT count(*) FROM {of(spec.name)} child WHERE {r.column} IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM {of(r.parent)} parent WHERE parent.{r.parent_column} = child.{r.column})""")
        for spec in specs.values() for r in spec.references if (r.parent == spec.name) == to_itself]


def _condition_problems(conditions_of: Callable[[Table], list[tuple[str, str]]], specs: dict[str, Table], of: Names) -> str:
    return " UNION ALL ".join(
        _problems(spec.name, label, f"SELECT count(*) FROM {of(spec.name)} WHERE NOT ({condition})")
        for spec in specs.values() for label, condition in conditions_of(spec))


def _checked(attribute: str, of: Names) -> str:
    return _condition_problems(
        lambda spec: [(f"CHECK ({condition})", condition) for condition in getattr(spec, attribute)], SOURCE, of)


def _domain(spec: Table) -> list[tuple[str, str]]:
    return [(f"CHECK ({name} IN ({', '.join(values)}))",
             f"{name} IN ({', '.join(repr(value) for value in values)})") for name, values in spec.domains.items()]


def _filled(spec: Table) -> list[tuple[str, str]]:
    return [(f"NOT NULL ({column.name})", f"{column.name} IS NOT NULL")
            for column in spec.columns if not column.nullable]


def _short(spec: Table) -> list[tuple[str, str]]:
    return [(f"LENGTH ({column.name}) <= {column.metadata['max_length']}",
             f"length({column.name}) <= {column.metadata['max_length']}")
            for column in spec.columns if "max_length" in column.metadata]


def _constraint_sql(of: Names = str) -> dict[str, str]:
    everything = {**SOURCE, **MART}
    raw_pairs = _problems("lineitem", "UNIQUE (o_custkey, l_partkey)", _repeats("o_custkey, l_partkey", "lines"))
    priorities = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    renamed = _problems("Ausencias", f"CHECK (TipoAusencia IN ({', '.join(priorities)}))",
                        f"SELECT count(*) FROM Ausencias WHERE TipoAusencia NOT IN {priorities}")
    return {
        "c01_primary_keys": " UNION ALL ".join(_key_problems(spec, of) for spec in everything.values()),
        "c02_unique": " UNION ALL ".join(_unique_problems(False, of)),
        "c03_unique_pair": " UNION ALL ".join([*_unique_problems(True, of), raw_pairs]),
        "c04_source_references": " UNION ALL ".join(_reference_problems(SOURCE, False, of)),
        "c05_manager_reference": " UNION ALL ".join(_reference_problems(SOURCE, True, of)),
        "c06_mart_references": " UNION ALL ".join(_reference_problems(MART, False, of)),
        "c07_domains": _condition_problems(_domain, SOURCE, of),
        "c07_domain_parameter": renamed,
        "c08_amounts": _checked("amounts", of),
        "c09_order": _checked("orders", of),
        "c10_ranges": _checked("ranges", of),
        "c11_not_null": _condition_problems(_filled, everything, of),
        "c12_status_pairing": _checked("pairings", of),
        "c_len": _condition_problems(_short, everything, of),
    }


def _changed(table: str, key: str, **values: tuple[int, str]) -> str:
    """table with a value in each row whose key is a multiple of a number."""
    found = ", ".join(f"CASE WHEN {key} % {step} = 0 THEN {value} ELSE {name} END AS {name}" for name, (step, value) in values.items())
    return f"SELECT * REPLACE ({found}) FROM {table}"


def _twice(rows: str, key: str, step: int) -> str:
    return f"SELECT * FROM ({rows}) UNION ALL SELECT * FROM ({rows}) WHERE {key} % {step} = 0"


def _faulty_ctes() -> str:
    """Every table again, with _f behind its name and faults inside."""
    early = "CAST(FechaInicio - INTERVAL 1 DAY AS DATE)"
    found = {
        "Oficinas": _twice("SELECT * FROM Oficinas", "OficinaID", 7),
        "Departamentos": _twice("SELECT * FROM Departamentos", "DepartamentoID", 2),
        "Puestos": _changed("Puestos", "PuestoID", SalarioMinimo=(13, "-1"), SalarioMaximo=(11, "-5"),
                            NivelSalarial=(17, "repeat('x', 25)")),
        "Empleados": _changed("Empleados", "EmpleadoID", JefeID=(13, "-5"), SalarioActual=(11, "0"), Email=(17, "NULL"),
                              Genero=(19, "'Ninguno'"), Nombre=(23, "repeat('x', 81)"), OficinaID=(29, "-1")),
        "Ausencias": _twice(_changed("Ausencias", "AusenciaID", EmpleadoID=(97, "-1"), FechaFin=(89, early)), "AusenciaID", 103),
        "EvaluacionesDesempeno": _changed("EvaluacionesDesempeno", "EvaluacionID", Calificacion=(89, "5.1"), EvaluadorID=(97, "-1")),
        "Capacitaciones": _changed("Capacitaciones", "CapacitacionID", Costo=(7, "-1"), FechaFin=(11, early)),
        "EmpleadosCapacitaciones": _changed("EmpleadosCapacitaciones", "EmpleadoCapacitacionID", CalificacionObtenida=(89, "101"),
                                            FechaCompletado=(83, "NULL"), CapacitacionID=(97, "-1")),
        "DimFecha": "SELECT * FROM DimFecha WHERE Anio <= 2000",
        "DimOficina": _twice("SELECT * FROM DimOficina", "OficinaKey", 7),
        "DimEmpleado": _twice(_changed("DimEmpleado", "EmpleadoKey", Genero=(13, "NULL"), DepartamentoID_OLTP=(17, "NULL"),
                                       AntiguedadAnios=(19, "-1")), "EmpleadoKey", 23),
        "DimTipoAusencia": _twice("SELECT * FROM DimTipoAusencia", "TipoAusenciaKey", 2),
        "FactAusencias": _changed("FactAusencias", "FactAusenciaKey", EmpleadoKey=(97, "-1"), DiasAusencia=(89, "0"))
        + " WHERE FactAusenciaKey % 101 <> 0",
        "FactEvaluaciones": _changed("FactEvaluaciones", "FactEvaluacionKey", EvaluadorEmpleadoKey=(97, "-1"),
                                     Calificacion=(89, "5.1"), tenths=(89, "51")) + " WHERE FactEvaluacionKey % 101 <> 0",
        "FactCapacitaciones": _changed("FactCapacitaciones", "FactCapacitacionKey", CapacitacionKey=(97, "NULL"),
                                       CostoCapacitacion=(89, "-1")) + " WHERE FactCapacitacionKey % 101 <> 0",
    }
    return "".join(f", {name}_f AS ({found.get(name, f'SELECT * FROM {name}')})\n" for name in (*SOURCE, *MART))


def _fault_sql() -> dict[str, str]:
    """The checks over the faulty tables, and the rows that break them."""
    def of(table: str) -> str:
        return f"{table}_f"

    checks = {**{f"v{n:02}": sql for n, sql in _verdict_sql(of).items()}, **_constraint_sql(of)}
    del checks["c03_unique_pair"], checks["c07_domain_parameter"]
    return {**{f"{name}_faults": sql for name, sql in checks.items()},
            "a16_repeated_ids": "SELECT AusenciaID, count(*) AS Filas FROM Ausencias_f GROUP BY AusenciaID HAVING count(*) > 1",
            "c04_orphans": """SELECT EmpleadoID, count(*) AS Filas FROM Ausencias_f
                WHERE EmpleadoID NOT IN (SELECT EmpleadoID FROM Empleados_f) GROUP BY EmpleadoID""",
            "c07_breaking": """SELECT EmpleadoID, Genero FROM Empleados_f
                WHERE Genero NOT IN ('Masculino', 'Femenino', 'No Binario', 'Otro')"""}


def oracle_statements() -> dict[str, str]:
    verdicts = _verdict_sql()
    report = " UNION ALL ".join(verdicts.values())
    bodies = {
        **_kpi_sql(),
        **_load_sql(),
        **{f"v{number:02}": sql for number, sql in verdicts.items()},
        "v15_detail": f"""SELECT Num AS "#", Categoria AS "Categoría", Nombre AS "Validación", Estado, Detalle, Problemas
            FROM ({report})""",
        "v16_summary": f"""
    SELECT count(*) AS "Total Validaciones", count(*) FILTER (WHERE Estado = 'PASS') AS "PASS ✓",
           count(*) FILTER (WHERE Estado = 'FAIL') AS "FAIL ✗",
           {_percent("count(*) FILTER (WHERE Estado = 'PASS')", "count(*)", 1)} AS "% Éxito"
    FROM ({report})""",
        **_constraint_sql(),
    }
    statements = {name: _ctes() + body for name, body in bodies.items()}
    faulty = _ctes() + _faulty_ctes()
    statements |= {name: faulty + body for name, body in _fault_sql().items()}
    narrow = _ctes(*NARROW)
    statements["v01_narrow_calendar"] = narrow + verdicts[1]
    statements["v16_narrow_calendar"] = narrow + bodies["v16_summary"]
    statements["c06_narrow_calendar"] = narrow + bodies["c06_mart_references"]
    return statements
