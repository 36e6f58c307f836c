"""Rules counted while a table is written, rows set aside, and loads that are refused."""

import pytest
from pyspark.sql import functions as F

from peoplemart.operators import checks
from peoplemart.plans import kpis
from peoplemart.plans.reload import BrokenRules, Mart, current, reloaded
from peoplemart.sources.schemas import MART
from peoplemart.sources.storage import new_folder, read_table, write_checked


@pytest.fixture
def faulty(source):
    """A source of which offices, departments and employees break rules of the mart."""
    long_name = F.when(F.col("EmpleadoID") % 10 == 0, F.repeat(F.lit("x"), 250)).otherwise(F.col("Nombre"))
    return {**{n: source[n] for n in source},
            "Oficinas": source["Oficinas"].withColumn("Ciudad", F.when(F.col("OficinaID") != 2, F.col("Ciudad"))),
            "Empleados": source["Empleados"].withColumn("Nombre", long_name).withColumn(
                "EstadoCivil", F.when(F.col("EmpleadoID") % 25 != 0, F.col("EstadoCivil")))}


def test_a_load_counts_what_a_scan_finds(spark, faulty, settings):
    mart = Mart(spark, faulty, new_folder(spark, "faulty"), settings)
    mart.load_all()
    tables = {name: mart[name] for name in MART}
    for rules_of in (checks.filled_rules, checks.length_rules, checks.row_rules):
        counted, scanned = mart.rule_report(rules_of), checks.rule_checks(tables, MART, rules_of)
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, scanned.collect()))
    found = {(r.Tabla, r.Restriccion): r.Problemas for r in mart.rule_report(checks.row_rules).collect() if r.Problemas}
    assert found == {("DimOficina", "NOT NULL (Ciudad)"): 1, ("DimEmpleado", "LENGTH (NombreCompleto) <= 220"): 5,
                     ("DimEmpleado", "NOT NULL (EstadoCivil)"): 2}


def test_rows_that_break_rules_are_set_aside(spark, faulty, settings):
    mart = Mart(spark, faulty, new_folder(spark, "aside"), settings)
    aside = {r.EmpleadoID_OLTP: r.Restricciones for r in mart.quarantined("DimEmpleado").collect()}
    assert aside == {**{i: ["LENGTH (NombreCompleto) <= 220"] for i in (10, 20, 30, 40)}, 25: ["NOT NULL (EstadoCivil)"],
                     50: ["NOT NULL (EstadoCivil)", "LENGTH (NombreCompleto) <= 220"]}
    assert mart["DimEmpleado"].count() == 50 and "Restricciones" not in mart["DimEmpleado"].columns
    none = mart.quarantined("DimPuesto")
    assert none.count() == 0 and none.columns == [*MART["DimPuesto"].schema.names, "Restricciones"]


def test_no_second_scan(spark, mart):
    """Reading the counters of a loaded mart runs no job."""
    mart.load_all()
    spark.sparkContext.setJobGroup("counters", "counters")
    report = mart.rule_report(checks.filled_rules)
    assert report.count() == sum(len(checks.filled_rules(spec)) for spec in MART.values())
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "BatchScan" not in plan
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_refused_load_leaves_the_former_one(spark, source, faulty, settings, tmp_path):
    root = f"file://{tmp_path}"
    reloaded(spark, source, root, settings, reject=True)
    before = kpis.absence_rate(current(spark, root)).collect()
    with pytest.raises(BrokenRules, match=r"NOT NULL \(Ciudad\)': 1") as refused:
        reloaded(spark, faulty, root, settings, reject=True)
    assert kpis.absence_rate(current(spark, root)).collect() == before
    assert len(list(tmp_path.glob("load-*"))) == 1
    folder = str(refused.value).split("in ")[1].split(": {")[0]
    assert spark.read.parquet(f"{folder}/DimOficina.parquet").select("OficinaID_OLTP").first()[0] == 2
    reloaded(spark, faulty, root, settings)  # reported, not refused
    assert current(spark, root)["DimOficina"].filter("Ciudad IS NULL").count() == 1


def test_an_unknown_condition_breaks_no_rule(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (None, -1)], "k int, v int")
    folder = new_folder(spark, "rules")
    found = write_checked(rows, folder, "t", [("k", F.col("k").isNotNull()), ("v", F.col("v") > 0)])
    assert found == (3, {"k": 1, "v": 1}) and read_table(spark, folder, "t").count() == 3
    assert write_checked(rows.limit(0), folder, "t", [("k", F.col("k") > 0)]) == (0, {"k": 0})
