"""Loads at the same time, appends that are repeated, and tables found by name."""

import threading

import pytest
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from peoplemart.plans import kpis
from peoplemart.plans.reload import ConcurrentLoad, Mart, current, reloaded
from peoplemart.sources.schemas import MART, SOURCE
from peoplemart.sources.storage import (
    Tables, _renamed, append_batch, appended_table, catalog_tables, create_once, new_folder, read_table, write_table)
from tests.test_scale import plan_of


def test_one_of_many_writers_creates_a_file(spark, tmp_path):
    path, won = f"file://{tmp_path}/pointers/1.json", []

    def write(i):
        if create_once(spark, path, f"writer {i}"):
            won.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(12)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(won) == 1 and (tmp_path / "pointers/1.json").read_text() == f"writer {won[0]}"
    assert [p.name for p in (tmp_path / "pointers").iterdir() if not p.name.startswith(".")] == ["1.json"]
    assert not create_once(spark, path, "late") and create_once(spark, path.replace("1.json", "2.json"), "next")


def test_stores_without_links_rename(spark, tmp_path):
    """The way of other stores, tried on local files: a name that is taken is kept, and said to be."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in ("a", "b"):
        (tmp_path / name).write_text(name)
    _renamed(spark, path(f"file://{tmp_path}/a"), path(f"file://{tmp_path}/taken"))
    with pytest.raises(Py4JJavaError) as refused:
        _renamed(spark, path(f"file://{tmp_path}/b"), path(f"file://{tmp_path}/taken"))
    assert "FileAlreadyExists" in refused.value.java_exception.getClass().getName()
    assert (tmp_path / "taken").read_text() == "a" and (tmp_path / "b").exists() and not (tmp_path / "a").exists()


def two_loads(spark, source, settings, root, **options):
    """Two loads that both begin before either is published, the second with an employee less; their outcomes."""
    begun, outcome = threading.Barrier(2), {}

    def waiting(table):
        begun.wait(60)
        return table

    def load(name, tables):
        try:
            reloaded(spark, Tables(tables), root, settings, **options)
            outcome[name] = "published"
        except ConcurrentLoad:
            outcome[name] = "refused"

    threads = []
    for name, least in (("all", 0), ("fewer", 1)):
        tables = {n: (lambda t=source[n]: t) for n in SOURCE}
        people = source["Empleados"].filter(F.col("EmpleadoID") > least)
        tables["Empleados"] = lambda t=people: waiting(t)
        threads.append(threading.Thread(target=inheritable_thread_target(spark)(load), args=(name, tables)))
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return outcome


def test_of_two_loads_at_once_one_is_published(spark, source, settings, tmp_path):
    root = f"file://{tmp_path}"
    outcome = two_loads(spark, source, settings, root)
    assert sorted(outcome.values()) == ["published", "refused"]
    winner = next(name for name, how in outcome.items() if how == "published")
    assert current(spark, root)["DimEmpleado"].count() == {"all": 50, "fewer": 49}[winner]
    assert len(list(tmp_path.glob("load-*"))) == 1
    reloaded(spark, source, root, settings)  # a load that begins afterwards follows it
    assert current(spark, root)["DimEmpleado"].count() == 50


def test_a_load_may_follow_a_newer_one(spark, source, settings, tmp_path):
    outcome = two_loads(spark, source, settings, f"file://{tmp_path}", replace_newer=True)
    assert set(outcome.values()) == {"published"}
    numbers = sorted(p.name for p in (tmp_path / "complete_loads").glob("*.json"))
    assert numbers == [f"{n:018d}.json" for n in (1, 2)]


def test_a_batch_appended_again_has_its_rows_once(spark, source):
    folder, rows = new_folder(spark, "append"), source["Ausencias"]
    schema = rows.schema
    first, second = rows.filter("AusenciaID <= 40"), rows.filter("AusenciaID > 40")
    assert append_batch(first, folder, "t", "2024-01") == 40
    assert append_batch(second.limit(7), folder, "t", "2024-02") == 7  # broken off
    assert append_batch(second, folder, "t", "2024-02") == 60
    assert append_batch(second, folder, "t", "2024-02") == 60
    both = appended_table(spark, folder, "t", schema)
    assert both.columns == schema.names and both.exceptAll(rows).count() == 0 and rows.exceptAll(both).count() == 0
    single = appended_table(spark, folder, "t", schema, ["2024-01"])
    assert single.count() == 40 and "_lote" in plan_of(single).split("PartitionFilters: ")[1].split("]")[0]
    assert append_batch(rows.limit(0), folder, "t", "2024-03") == 0 and both.count() == 100
    assert append_batch(rows.limit(0), folder, "t", "2024-01") == 0 and appended_table(spark, folder, "t", schema).count() == 60
    with pytest.raises(ValueError):
        append_batch(rows, folder, "t", "a/b")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_mart_from_two_namespaces(spark, source, mart, settings):
    """People and events in tables of two databases, found by name."""
    names = list(SOURCE)
    folders = {"hr_people": names[:4], "hr_events": names[4:]}
    found = {}
    for space, own in folders.items():
        home = new_folder(spark, space)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {space} LOCATION '{home}'")
        for name in own:
            write_table(source[name], home, name)
            spark.sql(f"DROP TABLE IF EXISTS {space}.{name}")
            spark.catalog.createTable(f"{space}.{name}", f"{home}/{name}.parquet", "parquet")
        found |= {name: (lambda n=name, t=catalog_tables(spark, space, {n: SOURCE[n].schema for n in own}): t[n]) for name in own}
    loaded = Mart(spark, Tables(found), new_folder(spark, "two"), settings)
    loaded.load_all()
    for name in MART:
        assert loaded[name].exceptAll(mart[name]).count() == 0 and mart[name].exceptAll(loaded[name]).count() == 0
    assert kpis.absence_rate(loaded).collect() == kpis.absence_rate(mart).collect()
    with pytest.raises(Exception, match="(?i)not.found"):
        catalog_tables(spark, "spark_catalog.hr_people", {"Ausencias": SOURCE["Ausencias"].schema})["Ausencias"].count()
    assert catalog_tables(spark, "spark_catalog.hr_people", {"Oficinas": SOURCE["Oficinas"].schema})["Oficinas"].count() == 5
    assert read_table(spark, home, names[-1]).count() > 0
