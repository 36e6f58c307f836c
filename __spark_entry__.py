"""Registered queries, their SQL counterparts, and the flagship query."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from functools import partial
from pathlib import Path
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))  # also when loaded from elsewhere

from peoplemart.operators import assign, checks
from peoplemart.operators.keys import dense_keys
from peoplemart.operators.references import orphans
from peoplemart.plans import dims, kpis, quality
from peoplemart.plans.calendar import calendar, calendar_over
from peoplemart.plans.reload import Mart, Settings, bucketed, table_counts
from peoplemart.sources.roles import (
    AS_OF, CALENDAR_END, CALENDAR_START, LINE_ORDER, enrolment_lines, role_tables)
from peoplemart.sources.schemas import MART, SOURCE
from peoplemart.sources.session import fit_shuffles, shuffle_parts
from peoplemart.sources.storage import (
    Tables, append_batch, appended_table, catalog_tables, new_folder, numbers_up_to, read_table, removed, stored_bytes)
from verification.faults import faulty_mart, faulty_source
from verification.oracle import oracle_statements

try:
    import corpus_pipeline
    from peoplemart.llm import queries as corpus_queries
except ModuleNotFoundError as missing:  # the library is complete without its training-data operators
    if missing.name not in ("corpus_pipeline", "peoplemart.llm"):
        raise
    corpus_pipeline = corpus_queries = None

SETTINGS = Settings(AS_OF, CALENDAR_START, CALENDAR_END)
NARROW_CALENDAR = (date(1996, 1, 1), date(2000, 12, 31))

_marts: dict[tuple[str, str], Mart] = {}
_bucketed: dict[tuple[str, str], Tables] = {}


def loaded_mart(spark: SparkSession, folder: str) -> Mart:
    """The mart over the test tables in folder. Its tables are loaded on first use, then shared
    by the queries of this application, whose shuffles are as many as the tables' files ask for."""
    fit_shuffles(spark, stored_bytes(spark, folder, ("customer", "part", "orders", "lineitem")))
    key = (spark.sparkContext.applicationId, folder)
    if key not in _marts:
        _marts[key] = Mart(spark, role_tables(spark, folder), new_folder(spark, "mart"), SETTINGS)
    return _marts[key]


def _bucketed_mart(spark: SparkSession, folder: str) -> Tables:
    """The mart as tables dealt by employee, in a namespace of their own, made on first use."""
    space = f"peoplemart_by_employee_{crc32(folder.encode())}"
    key = (spark.sparkContext.applicationId, space)
    if key not in _bucketed:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {space} LOCATION '{new_folder(spark, 'bucketed')}'")
        _bucketed[key] = bucketed(loaded_mart(spark, folder), space, shuffle_parts(spark))
    return _bucketed[key]


def _comparable(df: DataFrame) -> DataFrame:
    """df in the few types both engines share: bigint, double, string, boolean."""
    def column(spec: T.StructField):
        match spec.dataType:
            case T.DecimalType() | T.DoubleType():
                kind = "double"
            case T.IntegerType() | T.LongType():
                kind = "bigint"
            case T.BooleanType():
                kind = "boolean"
            case T.TimestampNTZType():
                return F.col(spec.name).cast("date").cast("string").alias(spec.name)
            case _:
                kind = "string"
        return F.col(spec.name).cast(kind).alias(spec.name)

    return df.select([column(spec) for spec in df.schema])


def _missing_as_double(df: DataFrame, name: str) -> DataFrame:
    """A bigint that may be missing, as double: clients agree on how those arrive."""
    return df.withColumn(name, F.col(name).cast("double"))


def _on_mart(plan: Callable[..., DataFrame], **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _comparable(plan(loaded_mart(spark, folder), **options))


def _on_tables(plan: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _comparable(plan(spark, folder))


def _with_narrow_calendar(mart: Mart) -> Tables:
    return mart.replaced(DimFecha=calendar(mart.spark, *NARROW_CALENDAR))


def _found_calendar(spark: SparkSession, folder: str, language: str) -> DataFrame:
    """The calendar of all years that occur in the order and ship dates."""
    ordered = read_table(spark, folder, "orders").select(F.col("o_orderdate").alias("day"))
    shipped = read_table(spark, folder, "lineitem").select(F.col("l_shipdate").alias("day"))
    return calendar_over(ordered.unionByName(shipped), "day", language)


def _verdict(number: int) -> Callable[[SparkSession, str], DataFrame]:
    return _on_mart(lambda mart: quality.verdicts(
        mart, mart.source, CALENDAR_START, CALENDAR_END, [number]))


def _detail(mart: Mart, narrow: bool = False) -> DataFrame:
    tables = _with_narrow_calendar(mart) if narrow else mart
    return quality.detail_report(tables, mart.source, CALENDAR_START, CALENDAR_END)


def _all_tables(mart: Mart) -> Tables:
    return Tables({
        **{name: (lambda n=name: mart.source[n]) for name in SOURCE},
        **{name: (lambda n=name: mart[n]) for name in MART},
    })


_EVERY = {**SOURCE, **MART}


def _place(mart: Mart, fact: str) -> DataFrame:
    """A fact with the natural keys of employee, office and department."""
    return (
        mart[fact]
        .join(mart["DimEmpleado"].select("EmpleadoKey", "EmpleadoID_OLTP"), "EmpleadoKey")
        .join(mart["DimOficina"].select("OficinaKey", "CodigoOficina"), "OficinaKey")
        .join(mart["DimDepartamento"].select("DepartamentoKey", "NombreDepartamento"), "DepartamentoKey")
    )


def _fact_absence(mart: Mart) -> DataFrame:
    return _place(mart, "FactAusencias").join(mart["DimTipoAusencia"], "TipoAusenciaKey").select(
        "FactAusenciaKey", "FechaKey", "EmpleadoID_OLTP", "CodigoOficina", "NombreDepartamento", "TipoAusencia",
        "CantidadAusencias", "DiasAusencia", "JustificadaFlag")


def _fact_review(mart: Mart) -> DataFrame:
    reviewer = mart["DimEmpleado"].select(
        F.col("EmpleadoKey").alias("EvaluadorEmpleadoKey"), F.col("EmpleadoID_OLTP").alias("EvaluadorID_OLTP"))
    return (
        _place(mart, "FactEvaluaciones").join(reviewer, "EvaluadorEmpleadoKey")
        .join(mart["DimPuesto"], "PuestoKey").select(
            "FactEvaluacionKey", "FechaKey", "EmpleadoID_OLTP", "EvaluadorID_OLTP", "CodigoOficina", "NombreDepartamento",
            "NombrePuesto", "Calificacion", "CantidadEvaluaciones"))


def _fact_training(mart: Mart) -> DataFrame:
    return (
        _place(mart, "FactCapacitaciones").join(mart["DimPuesto"], "PuestoKey")
        .join(mart["DimCapacitacion"], "CapacitacionKey").select(
            "FactCapacitacionKey", "FechaKey", "EmpleadoID_OLTP", "CapacitacionID_OLTP", "CodigoOficina", "NombreDepartamento",
            "NombrePuesto", "Estado", "CalificacionObtenida", "CantidadAsignaciones", "CostoCapacitacion"))


def _ages(mart: Mart) -> DataFrame:
    born = mart.source["Empleados"].select(F.col("EmpleadoID").alias("EmpleadoID_OLTP"), "FechaNacimiento")
    return mart["DimEmpleado"].join(born, "EmpleadoID_OLTP").select("EmpleadoID_OLTP", "FechaNacimiento", "Edad")


def _load_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Loads a second, complete mart, reports the rows written to each table, and removes it again."""
    again = Mart(spark, loaded_mart(spark, folder).source, new_folder(spark, "mart"), SETTINGS)
    report = again.load_all()
    removed(spark, again.folder)
    return report


def _appended(spark: SparkSession, folder: str) -> DataFrame:
    """Orders appended in two batches, the second of them twice, as after a failure."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    home = new_folder(spark, "append")
    append_batch(orders.filter("year < 1995"), home, "orders", "until-1994")
    for _ in range(2):
        append_batch(orders.filter("year >= 1995"), home, "orders", "from-1995")
    return appended_table(spark, home, "orders", orders.schema)


def _by_catalog_name(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per market segment, from tables of two namespaces of the session's catalog."""
    spaces = {"peoplemart_sales": "orders", "peoplemart_people": "customer"}
    schemas = {name: read_table(spark, folder, name).schema for name in spaces.values()}
    for space, name in spaces.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {space} LOCATION '{new_folder(spark, space)}'")
        spark.sql(f"DROP TABLE IF EXISTS {space}.{name}")
        spark.catalog.createTable(f"{space}.{name}", f"{folder}/{name}.parquet", "parquet")
    orders, customer = (catalog_tables(spark, space, {name: schemas[name]})[name] for space, name in spaces.items())
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count("*").alias("orders"))


def _unique_pairs(mart: Mart, spark: SparkSession, folder: str) -> DataFrame:
    raw = checks.unique_report(enrolment_lines(spark, folder), "lineitem", ("o_custkey", "l_partkey"))
    return checks.unique_checks(_all_tables(mart), _EVERY, composite=True).unionByName(raw)


def _absence_domain(mart: Mart) -> DataFrame:
    """The absence types of the test tables, given as a parameter."""
    types = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    label = f"CHECK (TipoAusencia IN ({', '.join(types)}))"
    return checks.rule_report(
        mart.source["Ausencias"], "Ausencias", [(label, F.col("TipoAusencia").isin(*types))])


def _source_rules(rules_of) -> Callable[[SparkSession, str], DataFrame]:
    return _on_mart(lambda mart: checks.rule_checks(mart.source, SOURCE, rules_of))


def _all_rules(rules_of) -> Callable[[SparkSession, str], DataFrame]:
    """Rules of all tables: of the mart's as its load has counted them, of the source's by a scan each."""
    return _on_mart(lambda mart: checks.rule_checks(mart.source, SOURCE, rules_of).unionByName(mart.rule_report(rules_of)))


def _on_faults(plan: Callable[[Tables, Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """plan(mart, source) over tables with faults in them."""
    return _on_mart(lambda mart: plan(faulty_mart(mart), faulty_source(mart.source)))


def _everything(mart: Tables, source: Tables) -> Tables:
    return Tables({name: (lambda n=name, t=tables: t[n]) for tables in (source, mart) for name in tables})


def _fault_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The checks where they have something to find, and the rows that they find."""
    rules = {"c07_domains": checks.domain_rules, "c08_amounts": checks.amount_rules, "c09_order": checks.order_rules,
             "c10_ranges": checks.range_rules, "c12_status_pairing": checks.pairing_rules}
    found = {f"v{number:02}_faults": _on_faults(lambda mart, source, n=number: quality.verdicts(
        mart, source, CALENDAR_START, CALENDAR_END, [n])) for number in quality.CHECKS}
    found |= {f"{name}_faults": _on_faults(lambda mart, source, r=rule: checks.rule_checks(source, SOURCE, r))
              for name, rule in rules.items()}
    to_employee = next(r for r in SOURCE["Ausencias"].references if r.parent == "Empleados")
    return found | {
        "c01_primary_keys_faults": _on_faults(lambda mart, source: checks.key_checks(_everything(mart, source), _EVERY)),
        "c02_unique_faults": _on_faults(lambda mart, source: checks.unique_checks(_everything(mart, source), _EVERY, composite=False)),
        "c04_source_references_faults": _on_faults(lambda mart, source: checks.reference_checks(source, SOURCE)),
        "c05_manager_reference_faults": _on_faults(lambda mart, source: checks.reference_checks(source, SOURCE, to_itself=True)),
        "c06_mart_references_faults": _on_faults(lambda mart, source: checks.reference_checks(mart, MART)),
        "c11_not_null_faults": _on_faults(lambda mart, source: checks.rule_checks(_everything(mart, source), _EVERY, checks.filled_rules)),
        "c_len_faults": _on_faults(lambda mart, source: checks.rule_checks(_everything(mart, source), _EVERY, checks.length_rules)),
        "a16_repeated_ids": _on_faults(lambda mart, source: checks.repeated(source["Ausencias"], ["AusenciaID"])),
        "c04_orphans": _on_faults(lambda mart, source: orphans(source["Ausencias"], to_employee, source["Empleados"])),
        "c07_breaking": _on_faults(lambda mart, source: checks.breaking(
            source["Empleados"], checks.domain_rules(SOURCE["Empleados"])[0][1]).select("EmpleadoID", "Genero")),
    }


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _on_mart(kpi) for name, kpi in kpis.KPIS.items()}
    found |= {
        "q04_by_key": _on_mart(kpis.top_absent_employees, by_key=True),
        "q04_bucketed": _on_tables(lambda spark, folder: kpis.top_absent_employees(_bucketed_mart(spark, folder))),
        "q13_bucketed": _on_tables(lambda spark, folder: kpis.unjustified_absence_alerts(_bucketed_mart(spark, folder))),
        "q07_1998": _on_mart(kpis.absence_rate, years=(1998, 1998)),
        "q07_1998_1999": _on_mart(kpis.absence_rate, years=(1998, 1999)),
        "q11_by_key": _on_mart(kpis.best_rated_per_department, by_key=True),
        "q13_by_key": _on_mart(kpis.unjustified_absence_alerts, by_key=True),
        "e01_calendar": _on_tables(partial(_found_calendar, language="es")),
        "e01_calendar_en": _on_tables(partial(_found_calendar, language="en")),
        "e02_dim_office": _on_mart(lambda mart: mart["DimOficina"]),
        "e02_dim_department": _on_mart(lambda mart: mart["DimDepartamento"]),
        "e02_dim_job": _on_mart(lambda mart: mart["DimPuesto"]),
        "e02_dim_training": _on_mart(lambda mart: mart["DimCapacitacion"]),
        "e03_keys": _on_mart(lambda mart: mart["DimEmpleado"].select("EmpleadoKey", "EmpleadoID_OLTP")),
        "e03_keys_large": _on_mart(lambda mart: dense_keys(
            mart.source["Ausencias"].select("AusenciaID"), ["AusenciaID"], "AusenciaKey")),
        "e04_dim_employee": _on_mart(lambda mart: _missing_as_double(
            mart["DimEmpleado"], "JefeID_OLTP")),
        "e04_dim_employee_full_years": _on_mart(lambda mart: dims.employee_rows(
            mart.source, AS_OF, full_years=True).select("EmpleadoID_OLTP", "NombreCompleto", "AntiguedadAnios")),
        "e05_age": _on_mart(_ages),
        "e06_dim_absence_type": _on_mart(lambda mart: mart["DimTipoAusencia"]),
        "e07_fact_absence": _on_mart(_fact_absence),
        "e08_fact_review": _on_mart(_fact_review),
        "e09_fact_training": _on_mart(_fact_training),
        "e11_counts": _on_mart(table_counts),
        "e11_source_counts": _on_mart(lambda mart: table_counts(mart.source).drop("Tipo")),
        "v01_narrow_calendar": _on_mart(lambda mart: quality.verdicts(
            _with_narrow_calendar(mart), mart.source, CALENDAR_START, CALENDAR_END, [1])),
        "v15_detail": _on_mart(_detail),
        "v16_summary": _on_mart(lambda mart: quality.summary_report(_detail(mart))),
        "v16_narrow_calendar": _on_mart(lambda mart: quality.summary_report(_detail(mart, narrow=True))),
        "c01_primary_keys": _on_mart(lambda mart: checks.key_checks(_all_tables(mart), _EVERY)),
        "c02_unique": _on_mart(lambda mart: checks.unique_checks(_all_tables(mart), _EVERY, composite=False)),
        "c03_unique_pair": lambda spark, folder: _comparable(_unique_pairs(loaded_mart(spark, folder), spark, folder)),
        "c04_source_references": _on_mart(lambda mart: checks.reference_checks(mart.source, SOURCE)),
        "c05_manager_reference": _on_mart(
            lambda mart: checks.reference_checks(mart.source, SOURCE, to_itself=True)),
        "c06_mart_references": _on_mart(lambda mart: checks.reference_checks(mart, MART)),
        "c06_narrow_calendar": _on_mart(
            lambda mart: checks.reference_checks(_with_narrow_calendar(mart), MART)),
        "c07_domains": _source_rules(checks.domain_rules),
        "c07_domain_parameter": _on_mart(_absence_domain),
        "c08_amounts": _source_rules(checks.amount_rules),
        "c09_order": _source_rules(checks.order_rules),
        "c10_ranges": _source_rules(checks.range_rules),
        "c11_not_null": _all_rules(checks.filled_rules),
        "c12_status_pairing": _source_rules(checks.pairing_rules),
        "c_len": _all_rules(checks.length_rules),
        "s02_catalog_names": _on_tables(_by_catalog_name),
        "s07_append": _on_tables(_appended),
        "s03_dump": _on_mart(lambda mart: mart["FactAusencias"].select("*")),
        "s05_sequence": _on_tables(lambda spark, folder: numbers_up_to(
            spark, read_table(spark, folder, "customer").count())),
        "s10_load_audit": _on_tables(_load_audit),
        "g01_round_robin": _on_tables(lambda spark, folder: assign.round_robin(
            read_table(spark, folder, "orders"), "o_orderkey",
            read_table(spark, folder, "customer"), "c_custkey")),
        "g02_distinct_pairs": _on_tables(lambda spark, folder: assign.first_of_each(
            enrolment_lines(spark, folder), ["o_custkey", "l_partkey"], LINE_ORDER)),
        "g04_manager": _on_tables(lambda spark, folder: _missing_as_double(assign.managers_of(
            read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment"),
            "c_mktsegment", "c_custkey", "JefeID"), "JefeID")),
    }
    found |= {f"v{number:02}": _verdict(number) for number in quality.CHECKS}
    return found | _fault_queries()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = library_queries()
    if corpus_queries:
        found |= corpus_queries.QUERIES | corpus_queries.FURTHER | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_statements()
    if corpus_queries:
        found |= corpus_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Absence rate and risk level per department."""
    return queries()["q07"](spark, "/root/testdata/sf0.001")
