"""Counts, least and greatest values from the files' statistics."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from peoplemart.operators.references import reference_profile
from peoplemart.plans import quality
from peoplemart.plans.reload import FACTS, SCHEMAS, table_counts
from peoplemart.sources.schemas import MART, SOURCE
from peoplemart.sources.storage import counting_session, new_folder, saved_tables, write_table
from tests.people import CALENDAR_END, CALENDAR_START
from tests.test_scale import plan_of


def scans(df):
    return [line for line in plan_of(df).splitlines() if "BatchScan" in line or "FileScan" in line]


@pytest.fixture(scope="module")
def saved_source(spark, source):
    folder = new_folder(spark, "source")
    for name in SOURCE:
        write_table(source[name], folder, name)
    return saved_tables(spark, folder, {name: spec.schema for name, spec in SOURCE.items()})


def test_counts_read_no_column(mart, saved_source):
    for tables in (mart, saved_source):
        counts = table_counts(tables)
        lines = scans(counts)
        assert len(lines) == len(tables)
        assert {row.Tabla: row.Registros for row in counts.collect()} == {name: tables[name].count() for name in tables}
        assert all("PushedAggregation: [COUNT(*)]" in line and "ReadSchema: struct<count(*):bigint>" in line for line in lines)


@pytest.mark.parametrize("number", [8, 9, 14])
def test_matching_counts_come_from_both_sides_statistics(mart, saved_source, number):
    report = quality.verdicts(mart, saved_source, CALENDAR_START, CALENDAR_END, [number])
    assert [line.count("PushedAggregation: [COUNT(*)]") for line in scans(report)] == [1, 1]
    assert report.collect() == quality.verdicts(mart, mart.source, CALENDAR_START, CALENDAR_END, [number]).collect()
    fewer = mart.replaced(**{name: mart[name].limit(3) for name in FACTS})
    assert quality.verdicts(fewer, saved_source, CALENDAR_START, CALENDAR_END, [number]).first().Estado == "FAIL"


def test_calendar_span_comes_from_statistics(mart):
    report = quality.verdicts(mart, mart.source, CALENDAR_START, CALENDAR_END, [12])
    line, = scans(report)
    assert "PushedAggregation: [MIN(FechaCompleta), MAX(FechaCompleta)]" in line
    assert report.first().Estado == "PASS"
    assert quality.verdicts(mart, mart.source, date(1900, 1, 1), CALENDAR_END, [12]).first().Estado == "FAIL"


def test_other_scans_and_options_stay_as_they_are(spark, mart):
    counting_session(spark)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList").split(",")
    assert "FileScan" in plan_of(mart["FactAusencias"].agg(F.count("*")))


def test_ranges_of_a_saved_mart(spark, mart):
    tables = saved_tables(spark, mart.folder, SCHEMAS, FACTS)
    assert tables.key_range("DimEmpleado", "EmpleadoKey") == (1, 50) and tables.key_range("DimEmpleado", "NombreCompleto") is None
    for fact in FACTS:
        profile = reference_profile(tables[fact], MART[fact].references, tables, {})
        assert "bitmap" in plan_of(profile)
        assert profile.first() == reference_profile(mart[fact], MART[fact].references, dict(mart), {}).first()
