"""Properties that matter on large data: plan shapes, hot keys, repeatable loads."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from peoplemart.operators import assign, checks, keys
from peoplemart.operators.references import lost, orphans, reference_profile
from peoplemart.plans import facts, kpis, quality
from peoplemart.plans.reload import FACTS, SCHEMAS, Mart, current, reloaded, remove_former
from peoplemart.sources.schemas import MART, Reference
from peoplemart.sources.session import cluster_options
from peoplemart.sources.storage import Tables, new_folder, saved_tables, shared_folder, staged
from tests.people import CALENDAR_END, CALENDAR_START


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    old = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            old.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(kpis.KPIS))
def test_kpi_plans_have_no_nested_loops(mart, name):
    plan = plan_of(kpis.KPIS[name](mart))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_quality_plan_has_no_nested_loops(mart, source):
    plan = plan_of(quality.detail_report(mart, source, CALENDAR_START, CALENDAR_END))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("HashJoin") >= 17


def test_one_scan_per_fact_in_the_quality_report(mart, source):
    plan = plan_of(quality.detail_report(mart, source, CALENDAR_START, CALENDAR_END))
    for column in ("DiasAusencia", "Calificacion", "CostoCapacitacion"):
        assert sum("FileScan" in line and column in line.split("Batched")[0] for line in plan.splitlines()) == 1


def test_scans_read_only_needed_columns(mart):
    lines = [line for line in plan_of(kpis.absence_rate(mart)).splitlines() if "FileScan" in line]
    schemas = [line.split("ReadSchema: ")[1] for line in lines]
    assert schemas[0] == "struct<EmpleadoKey:bigint,DepartamentoKey:bigint,DiasAusencia:int>"


def test_active_filter_reaches_the_scan(mart):
    plan = kpis.seniority_by_department(mart)._jdf.queryExecution().explainString(
        mart.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(Activo,true)" in plan


def test_first_of_each_reduces_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("a"), F.col("id").alias("n"))
    plan = plan_of(assign.first_of_each(rows, ["a"], ["n"]))
    lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert "Final" in lines[0] and "Exchange" in lines[1] and "Partial" in lines[2]


def hot_absences(spark, source, rows=30_000):
    """Absences of which employee 1 has a third."""
    person = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 1)
    day = F.date_add(F.lit(CALENDAR_START), (F.col("id") % 1000).cast("int"))
    return spark.range(0, rows, 1, 8).select(
        person.cast("long").alias("EmpleadoID"), F.lit("Vacaciones").alias("TipoAusencia"),
        day.alias("FechaInicio"), F.lit(1).alias("DiasTotales"), (F.col("id") % 2 == 0).alias("Justificada"))


def test_adaptive_execution_splits_a_hot_employee_in_the_fact_load(spark, mart, source, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
         spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__shuffle__partitions="16")
    events = staged(_with_ids(hot_absences(spark, source)), "hot")
    loaded = facts.absences({"Ausencias": events}, mart)
    rows = loaded.collect()
    assert len(rows) == 30_000
    assert "skew=true" in plan_of(loaded)


def test_hot_employee_is_folded_before_the_join(spark, mart, source):
    """A third of all rows for one employee: sums stay exact."""
    loaded = Mart(spark, {**{n: source[n] for n in source}, "Ausencias": staged(_with_ids(hot_absences(spark, source)), "hot")},
                  new_folder(spark, "hot"), mart.settings)
    report = kpis.top_absent_employees(loaded, by_key=True, limit=100).collect()
    assert sum(row.TotalDiasAusentes for row in report) == 30_000
    assert report[0].EmpleadoID_OLTP == 1 and report[0].TotalDiasAusentes == 10_000 + 400
    states = quality.verdicts(loaded, loaded.source, CALENDAR_START, CALENDAR_END, [1, 6, 8]).collect()
    assert {row.Estado for row in states} == {"PASS"}


def _with_ids(df):
    return df.withColumn("AusenciaID", F.monotonically_increasing_id())


def test_orphans_are_counted_after_folding(spark):
    """A missing parent that a third of the rows name is one row at the join."""
    child = spark.range(0, 9000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 10).alias("k"))
    parent = spark.range(10).withColumnRenamed("id", "k")
    missing = orphans(child, Reference("k", "p", "k"), parent)
    assert [tuple(row) for row in missing.collect()] == [(-1, 3000)]
    row = reference_profile(child, [Reference("k", "p", "k")], {"p": parent}, {}).first()
    assert (row.Filas, row.Huerfanas, row[lost(0)]) == (9000, 3000, 3000)


def test_reference_profile_agrees_with_a_plain_computation(mart):
    """Lost and missing references, counted for each and for any of them; repeated parents count once."""
    training = mart["FactCapacitaciones"].withColumn(
        "EmpleadoKey", F.when(F.col("EmpleadoKey") % 7 == 0, -1).otherwise(F.col("EmpleadoKey"))).withColumn(
        "CapacitacionKey", F.when(F.col("CapacitacionKey") % 4 == 0, None).otherwise(F.col("CapacitacionKey")))
    references = MART["FactCapacitaciones"].references
    parents = {name: mart[name].unionAll(mart[name]) for name in mart}
    row = reference_profile(training, references, parents, {"caro": F.col("CostoCapacitacion") > 1000}).first()
    known = {r.column: {x[0] for x in mart[r.parent].select(r.parent_column).collect()} for r in references}
    rows = training.collect()
    assert row.Filas == len(rows) and row.caro == sum(x.CostoCapacitacion > 1000 for x in rows)
    assert 0 < row.Huerfanas == sum(any(x[c] not in keys for c, keys in known.items()) for x in rows) < len(rows)
    for i, r in enumerate(references):
        assert row[lost(i)] == sum(x[r.column] is not None and x[r.column] not in known[r.column] for x in rows)


def test_foreign_keys_read_each_fact_once(mart):
    plan = plan_of(checks.reference_checks(mart, MART))
    scans = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "FileScan" in line]
    for column in ("TipoAusenciaKey", "EvaluadorEmpleadoKey", "CapacitacionKey"):
        assert sum(f"{column}:" in scan and "FechaKey:" in scan for scan in scans) == 1


def test_adaptive_execution_splits_a_hot_reference(spark, conf):
    """A third of the rows refer to one employee, in pairs that are nearly unique."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
         spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__shuffle__partitions="16")
    pairs = staged(spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("e"), (F.col("id") % 40_000).alias("p")), "pairs")
    parents = {"E": staged(spark.range(500).withColumnRenamed("id", "k"), "e"), "P": staged(spark.range(39_990).withColumnRenamed("id", "k"), "p")}
    profile = reference_profile(pairs, [Reference("e", "E", "k"), Reference("p", "P", "k")], parents, {})
    row = profile.collect()[0]
    assert (row.Filas, row.Huerfanas, row[lost(0)]) == (90_000, row[lost(1)], 0) and row.Huerfanas > 0
    assert "skew=true" in plan_of(profile)


def test_no_job_runs_while_checks_are_planned(spark, mart, source):
    for name in mart:
        assert mart[name] is not None and all(source[n] is not None for n in source)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    quality.verdicts(mart, source, CALENDAR_START, CALENDAR_END)
    checks.reference_checks(mart, MART)
    assert len(tracker.getJobIdsForGroup("planning")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reload_is_repeatable(spark, source, mart, settings):
    """Loading again, and over the same folder, gives the same tables, keys included."""
    folder = new_folder(spark, "again")
    Mart(spark, source, folder, settings).load_all()
    again = Mart(spark, source, folder, settings)
    again.load_all()
    for name in MART:
        first, second = mart[name], again[name]
        assert first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0
        assert again[name].select(MART[name].key).distinct().count() == again[name].count()


def test_readers_see_complete_loads_only(spark, source, settings, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        current(spark, root)
    assert {r.Tabla: r.Registros for r in reloaded(spark, source, root, settings).collect()}["FactAusencias"] == 100
    before = kpis.absence_rate(current(spark, root)).collect()

    def broken():
        raise RuntimeError("the source went away")

    fewer = {**{n: source[n] for n in source}, "Empleados": source["Empleados"].filter("EmpleadoID > 1")}
    failing = Tables({**{n: (lambda t=t: t) for n, t in fewer.items()}, "EvaluacionesDesempeno": broken})
    with pytest.raises(RuntimeError):
        reloaded(spark, failing, root, settings)  # the dimensions are written by then, with other keys
    assert kpis.absence_rate(current(spark, root)).collect() == before
    reloaded(spark, fewer, root, settings)
    assert current(spark, root)["DimEmpleado"].count() == 49
    assert remove_former(spark, root) == 1 and remove_former(spark, root) == 0
    assert current(spark, root)["DimEmpleado"].count() == 49
    left = list(tmp_path.glob("load-*"))
    assert len(left) == 1 and not (left[0] / "_staging").exists()


def test_saved_mart_is_read_with_its_declared_schema(spark, mart):
    tables = saved_tables(spark, mart.folder, SCHEMAS, FACTS)
    assert tables["DimEmpleado"].count() == 50
    assert [row.TasaAusentismoPct for row in kpis.absence_rate(tables).collect()] == [
        row.TasaAusentismoPct for row in kpis.absence_rate(mart).collect()]


def test_loaded_types_are_the_declared_ones(mart):
    for name, spec in MART.items():
        found = [(c.name, c.dataType) for c in mart[name].schema]
        assert found == [(c.name, c.dataType) for c in spec.columns]


def test_keys_by_range_use_no_single_task(spark):
    """The shifts are the only single-partition step, with one row per range."""
    numbered = keys.dense_keys(spark.range(50_000), ["id"], "k")
    assert plan_of(numbered).count("Window") == 1
    assert numbered.select(F.max("k"), F.count_distinct("k")).first()[:] == (50_000, 50_000)


def test_shared_folder_comes_from_the_session(spark, conf):
    assert shared_folder(spark)
    if spark.conf.get("spark.checkpoint.dir", None):
        assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_cluster_options_bound_the_partition_size():
    options = cluster_options(shuffled_bytes=10 * 2**40, cores=8000)
    assert int(options["spark.sql.shuffle.partitions"]) == 81920
    assert cluster_options(shuffled_bytes=1, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_a_year_is_read_from_its_folder_alone(spark, mart):
    for tables in (mart, saved_tables(spark, mart.folder, SCHEMAS, FACTS)):
        rate = kpis.absence_rate(tables, years=(2024, 2024))
        scan = next(line for line in plan_of(rate).splitlines() if "FileScan" in line and "DiasAusencia" in line)
        assert "(_anio" in scan.split("PartitionFilters: ")[1].split("]")[0] and "2024" in scan
        assert sum(row.TotalDiasAusentes for row in rate.collect()) == 98
    folders = {path.name for path in Path(mart.folder.removeprefix("file:")).glob("FactAusencias.parquet/_anio=*")}
    assert folders == {"_anio=2023", "_anio=2024"}


def test_facts_are_clustered_by_employee(mart):
    """Files of a year are sorted by employee, and a small fact makes a few files, not hundreds."""
    for fact in FACTS:
        files = list(Path(mart.folder.removeprefix("file:")).glob(f"{fact}.parquet/_anio=*/*.parquet"))
        assert 0 < len(files) <= 12
        for file in files:
            people = pq.read_table(file, columns=["EmpleadoKey"])["EmpleadoKey"].to_pylist()
            assert people == sorted(people)


def test_many_people_on_one_place(spark):
    """Most of a department shares the first mean: the same rows as a plain rank, and no window over people."""
    rng = random.Random(4)
    people = [(i, i % 2 + 1, 50 if rng.random() < 0.6 else rng.choice((38, 42, 46))) for i in range(4000)]
    people += [(5000, 3, 30), (5001, 3, 20), (5002, 3, 20), (5003, 3, 10)]
    ratings = spark.createDataFrame(people, "EmpleadoKey long, DepartamentoKey long, tenths int").withColumn(
        "Calificacion", (F.col("tenths") / 10).cast("decimal(3,1)"))
    names = spark.createDataFrame([(i, i, f"p{i}") for i, *_ in people], "EmpleadoKey long, EmpleadoID_OLTP long, NombreCompleto string")
    departments = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "DepartamentoKey long, NombreDepartamento string")
    report = kpis.best_rated_per_department(
        {"FactEvaluaciones": ratings, "DimEmpleado": names, "DimDepartamento": departments}, by_key=True)
    expected = set()
    for i, d, t in people:
        rank = 1 + sum(t2 > t for _, d2, t2 in people if d2 == d) if d == 3 or t == 50 else 4
        if rank <= 3:
            expected.add((" ABC"[d], rank, i))
    assert {(r.NombreDepartamento, r.Ranking, r.EmpleadoID_OLTP) for r in report.collect()} == expected
    plan = plan_of(report)
    assert "rank(" not in plan and all("NombreCompleto" not in line for line in plan.splitlines() if " Window " in line)


def test_hot_pair_keeps_its_first_row_and_all_others(spark):
    """A third of all rows belong to one pair; the result equals a plain computation."""
    rows = [((0, 0) if n % 3 == 0 else (n % 11, n % 7), n * 7919 % 6007) for n in range(6000)]
    table = spark.createDataFrame([(a, b, n) for (a, b), n in rows], "a long, b long, n long").repartition(8)
    expected = {}
    for pair, n in rows:
        expected[pair] = min(n, expected.get(pair, n))
    found = {(row.a, row.b): row.n for row in assign.first_of_each(table, ["a", "b"], ["n"]).collect()}
    assert found == expected


def test_distinct_employees_are_counted_once_per_label(spark, mart):
    """Two offices with the same labels form one group, in which an employee counts once."""
    offices = spark.createDataFrame(
        [(1, "X", "P", "R"), (2, "X", "P", "R"), (3, "Y", "P", "R")],
        "OficinaKey long, Ciudad string, Pais string, Region string")
    training = spark.createDataFrame(
        [(1, 10, 5.0), (2, 10, 5.0), (2, 11, 6.0), (3, 10, 1.0)],
        "OficinaKey long, EmpleadoKey long, cost double").withColumn("CostoCapacitacion", F.col("cost").cast("decimal(12,2)"))
    report = kpis.training_by_office({"FactCapacitaciones": training, "DimOficina": offices}).collect()
    assert [(r.Ciudad, r.EmpleadosCapacitados, r.TotalAsignaciones, str(r.InversionPorEmpleado)) for r in report] == [
        ("X", 2, 3, "8.00"), ("Y", 1, 1, "1.00")]
