"""A mart dealt by employee in the catalog: same results, no shuffle of the facts."""

import pytest

import __spark_entry__ as registered
from peoplemart.operators.references import reference_profile
from peoplemart.plans import facts, kpis, quality
from peoplemart.plans.reload import FACTS, SCHEMAS, bucketed
from peoplemart.sources.schemas import MART
from peoplemart.sources.storage import catalog_tables, new_folder, write_bucketed
from tests.people import CALENDAR_END, CALENDAR_START
from tests.test_scale import conf, hot_absences, plan_of  # noqa: F401

SPACE = "mart_by_employee"


@pytest.fixture(scope="module")
def dealt(spark, mart):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SPACE} LOCATION '{new_folder(spark, SPACE)}'")
    return bucketed(mart, SPACE, 4)


def exchanged(df):
    return [line for line in plan_of(df).splitlines() if "Exchange" in line and "ReusedExchange" not in line]


def test_the_copy_holds_the_mart(spark, mart, dealt):
    for tables in (dealt, catalog_tables(spark, SPACE, SCHEMAS)):
        for name in MART:
            assert tables[name].exceptAll(mart[name]).count() == 0 and mart[name].exceptAll(tables[name]).count() == 0


def test_the_registered_copy_has_buckets_that_fit_the_input(spark, monkeypatch):
    """As many as shuffles have partitions: with a fixed number a bucket, which one task sorts, would grow with the input."""
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "23")
    monkeypatch.setattr(registered, "_bucketed", {})
    monkeypatch.setattr(registered, "loaded_mart", lambda *_: None)
    monkeypatch.setattr(registered, "bucketed", lambda mart, space, buckets: buckets)
    assert registered._bucketed_mart(session, "large") == 23


@pytest.mark.parametrize("name", ["q04", "q11", "q13"])
def test_kpis_by_employee_shuffle_no_fact(mart, dealt, conf, name):  # noqa: F811
    """With broadcasts off, facts are folded and joined to the employees where they lie."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    report = kpis.KPIS[name](dealt)
    assert not any("EmpleadoKey" in line.split("ENSURE")[0] for line in exchanged(report))
    assert any("EmpleadoKey" in line.split("ENSURE")[0] for line in exchanged(kpis.KPIS[name](mart)))
    assert report.collect() == kpis.KPIS[name](mart).collect()


def test_employee_references_shuffle_no_fact(mart, dealt, conf):  # noqa: F811
    """V02's reference to the reviewed employee, and all of them by values: the fact stays where it lies for EmpleadoKey."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    to_employee = [r for r in MART["FactEvaluaciones"].references if r.column == "EmpleadoKey"]
    joined = dealt["FactEvaluaciones"].join(dealt["DimEmpleado"].select("EmpleadoKey", "NombreCompleto"), "EmpleadoKey")
    assert exchanged(joined) == [] and "SortMergeJoin" in plan_of(joined)
    profile = reference_profile(dealt["FactEvaluaciones"], to_employee, mart, {})
    assert profile.first() == reference_profile(mart["FactEvaluaciones"], to_employee, dict(mart), {}).first()
    report = quality.verdicts(mart.replaced(**{name: dealt[name] for name in FACTS}), mart.source, CALENDAR_START, CALENDAR_END, [2])
    assert not any("EmpleadoKey" in line or "_to_" in line for line in exchanged(report))
    assert report.first().Estado == "PASS"


def test_a_hot_employee_is_folded_where_it_lies(spark, mart, source, conf):  # noqa: F811
    """A third of all rows of one employee: one bucket is larger, the sums are exact."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS hot LOCATION '{new_folder(spark, 'hot')}'")
    events = hot_absences(spark, source).selectExpr("*", "monotonically_increasing_id() AS AusenciaID")
    write_bucketed(facts.absences({"Ausencias": events}, mart), "hot", "FactAusencias", "EmpleadoKey", 4)
    write_bucketed(mart["DimEmpleado"], "hot", "DimEmpleado", "EmpleadoKey", 4)
    own = catalog_tables(spark, "hot", {n: SCHEMAS[n] for n in ("FactAusencias", "DimEmpleado")})
    report = kpis.top_absent_employees({**{n: mart[n] for n in MART}, **{n: own[n] for n in own}}, by_key=True, limit=100)
    assert not any("EmpleadoKey" in line.split("ENSURE")[0] for line in exchanged(report))
    rows = report.collect()
    assert sum(r.TotalDiasAusentes for r in rows) == 30_000 and rows[0].TotalDiasAusentes == 10_400
