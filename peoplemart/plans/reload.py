"""Full reload of the mart: dimensions first, then the facts that use their keys."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplemart.operators import checks
from peoplemart.plans import dims, facts
from peoplemart.plans.calendar import calendar
from peoplemart.sources.schemas import MART, Table
from peoplemart.sources.storage import (
    SavedTables, Tables, catalog_tables, counted, create_once, removed, saved_tables, write_bucketed, write_checked)

SCHEMAS = {name: spec.schema for name, spec in MART.items()}
FACTS = tuple(name for name, spec in MART.items() if spec.references)
_POINTERS = "complete_loads"
BROKEN = "Restricciones"


@dataclass(frozen=True)
class Settings:
    """What a load depends on besides its source tables."""

    as_of: date
    calendar_start: date
    calendar_end: date
    language: str = "es"
    full_years: bool = False


class Mart(SavedTables):
    """The ten mart tables in a folder of their own, each loaded from the source on first use.

    A fact asks for its dimensions, so the load order follows from use. Every table is written and
    read back. Facts are written by year and sorted by employee. For a mart that readers use while
    it is loaded again, see reloaded.
    """

    def __init__(self, spark: SparkSession, source: Mapping[str, DataFrame], folder: str, settings: Settings):
        super().__init__(spark, folder, SCHEMAS, FACTS)
        self.source = source
        self.settings = settings
        self.staging = f"{folder}/_staging"
        self.loaded_rows: dict[str, int] = {}
        self.broken_rows: dict[str, dict[str, int]] = {}  # of each table, by the label of a rule
        self.quarantine = f"{folder}/_quarantine"

    def load_all(self) -> DataFrame:
        """Loads every table and reports the rows written to each (Tabla, Registros).

        Dimensions do not depend on each other and are loaded side by side, then the facts.
        """
        for names in ([n for n in MART if n not in FACTS], FACTS):
            with ThreadPoolExecutor(len(names)) as pool:
                list(pool.map(inheritable_thread_target(self.spark)(self.__getitem__), names))
        removed(self.spark, self.staging)
        rows = [(name, self.loaded_rows[name]) for name in MART]
        return self.spark.createDataFrame(rows, "Tabla string, Registros bigint")

    def _declared(self, name: str) -> DataFrame:
        table = self._built(name).select(MART[name].schema.names)
        layout = ("FechaKey", "EmpleadoKey") if name in FACTS else ()
        rules = checks.row_rules(MART[name])
        self.loaded_rows[name], self.broken_rows[name] = write_checked(table, self.folder, name, rules, *layout)
        saved = super()._declared(name)
        if any(self.broken_rows[name].values()):
            labels = F.filter(F.array(*[F.when(~holds, label) for label, holds in rules]), lambda label: label.isNotNull())
            saved.withColumn(BROKEN, labels).filter(F.size(BROKEN) > 0).write.mode("overwrite").parquet(f"{self.quarantine}/{name}.parquet")
        return saved

    def quarantined(self, name: str) -> DataFrame:
        """The rows of a table that break a rule, with the labels of the rules (Restricciones). They are in the table too."""
        saved = self[name]
        if any(self.broken_rows[name].values()):
            return self.spark.read.parquet(f"{self.quarantine}/{name}.parquet")
        return saved.withColumn(BROKEN, F.array().cast("array<string>")).limit(0)

    def rule_report(self, rules_of: Callable[[Table], checks.Rules]) -> DataFrame:
        """The rows of all mart tables that break a rule, as counted while they were written: Tabla, Restriccion, Problemas."""
        rows = []
        for name, spec in MART.items():
            self[name]  # loads it
            rows += [(name, label, self.broken_rows[name][label]) for label, _ in rules_of(spec)]
        return self.spark.createDataFrame(rows, "Tabla string, Restriccion string, Problemas bigint")

    def key_range(self, name: str, column: str) -> tuple[int, int] | None:
        """Surrogate keys are dense from 1, and days lie in the settings' calendar."""
        if column != MART[name].key or name in FACTS:
            return None
        if name == "DimFecha":
            first, last = self.settings.calendar_start, self.settings.calendar_end
            return tuple(day.year * 10000 + day.month * 100 + day.day for day in (first, last))
        self[name]  # loads it
        return 1, self.loaded_rows[name]

    def counted(self, name: str) -> DataFrame:
        self[name]  # loads it
        return super().counted(name)

    def in_years(self, name: str, first: int, last: int) -> DataFrame:
        self[name]  # loads it
        return super().in_years(name, first, last)

    def _built(self, name: str) -> DataFrame:
        settings, source = self.settings, self.source
        match name:
            case "DimFecha":
                return calendar(self.spark, settings.calendar_start, settings.calendar_end, settings.language)
            case "DimOficina":
                return dims.offices(source)
            case "DimDepartamento":
                return dims.departments(source)
            case "DimPuesto":
                return dims.jobs(source)
            case "DimEmpleado":
                return dims.employees(source, settings.as_of, settings.full_years)
            case "DimTipoAusencia":
                return dims.absence_types(source)
            case "DimCapacitacion":
                return dims.programmes(source)
            case "FactAusencias":
                return facts.absences(source, self)
            case "FactEvaluaciones":
                return facts.reviews(source, self)
            case "FactCapacitaciones":
                return facts.enrolments(source, self)
        raise KeyError(name)


class BrokenRules(ValueError):
    """A load was not published, since rows of it break declared rules."""


class ConcurrentLoad(RuntimeError):
    """A load was not published, since another one was while it ran."""


def reloaded(spark: SparkSession, source: Mapping[str, DataFrame], root: str, settings: Settings, reject: bool = False,
             replace_newer: bool = False) -> DataFrame:
    """Loads a new mart beside the last one and then makes it the current one; reports the rows written.

    With reject, a load with rows that break a rule is not published; the rows are left in a folder of root that the error names.
    What readers see is one small file with a number, which names the complete load, and which only one load can
    create. If another load has taken the next number since this one began, this one fails and leaves that mart in
    place; with replace_newer it takes the number after. A load that fails leaves the former mart in place."""
    name = f"load-{uuid.uuid4().hex}"
    number = _last_number(spark, root) + 1
    mart = Mart(spark, source, f"{root}/{name}", settings)
    if reject:
        mart.quarantine = f"{root}/quarantine-{name}"
    try:
        report = mart.load_all()
        broken = {f"{table}: {label}": n for table, found in mart.broken_rows.items() for label, n in found.items() if n}
        if reject and broken:
            raise BrokenRules(f"rows that break rules, in {mart.quarantine}: {broken}")
        while not create_once(spark, f"{root}/{_POINTERS}/{number:018d}.json", json.dumps({"number": number, "name": name})):
            if not replace_newer:
                raise ConcurrentLoad(f"another load was published as number {number} while {name} ran")
            number = max(number, _last_number(spark, root)) + 1
    except BaseException:
        removed(spark, f"{root}/{name}")
        raise
    return report


def current(spark: SparkSession, root: str) -> SavedTables:
    """The tables of the last complete load below root."""
    loads = _published(spark, root)
    if not loads:
        raise FileNotFoundError(f"no complete load below {root}")
    return saved_tables(spark, f"{root}/{loads[-1].name}", SCHEMAS, FACTS)


def remove_former(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Deletes the complete loads before the last `keep`; call it when nobody reads them any more."""
    former = _published(spark, root)[:-keep or None]
    return sum(removed(spark, f"{root}/{load.name}") for load in former)


def _published(spark: SparkSession, root: str) -> list:
    """One row per load, the first first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{_POINTERS}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    return spark.read.schema("number long, name string").json(path.toString()).orderBy("number").collect()


def _last_number(spark: SparkSession, root: str) -> int:
    return max((load.number for load in _published(spark, root)), default=0)


def bucketed(mart: SavedTables, namespace: str, buckets: int) -> Tables:
    """A copy of the mart in a namespace of the catalog, in which the facts and the employees are dealt by employee.

    For marts whose employees are too many to broadcast and whose facts are joined to them, or folded by them, often:
    each such query saves the shuffle that the copy has cost once. Queries find the tables by name later on, with
    catalog_tables. buckets: about a fact's bytes / 128 MB."""
    for name in MART:
        if name in FACTS or name == "DimEmpleado":
            write_bucketed(mart[name], namespace, name, "EmpleadoKey", buckets)
        else:
            mart[name].write.mode("overwrite").saveAsTable(f"{namespace}.{name}")
    return catalog_tables(mart.spark, namespace, SCHEMAS)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table, with its kind told by its name (Tabla, Tipo, Registros); of tables in files, by their statistics."""
    counts = None
    for name in tables:
        one = counted(tables, name).agg(F.count("*").alias("Registros")).withColumn("Tabla", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    kind = F.when(F.col("Tabla").like("Dim%"), "Dimensión").otherwise("Hecho")
    return counts.select("Tabla", kind.alias("Tipo"), "Registros")
