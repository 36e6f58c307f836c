"""Keys, assignment, numbers, dates and texts on their own."""

from collections import Counter
from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peoplemart.functions import dates, numeric, text
from peoplemart.operators import assign, keys
from peoplemart.plans.calendar import calendar
from peoplemart.sources import session, storage
from peoplemart.sources.schemas import SOURCE, conformed
from peoplemart.sources.storage import numbers_up_to
from tests.conftest import SMALL


def half_up(value: Fraction, digits: int) -> Decimal:
    scaled = abs(value) * 10**digits
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return (Decimal(whole) * (1 if value >= 0 else -1)).scaleb(-digits)


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_ratio_is_exact(spark, digits):
    pairs = spark.range(-300, 1500).select(F.col("id").alias("a")).crossJoin(
        spark.range(0, 200, 7).select(F.col("id").alias("b")))
    for a, b, found in pairs.select("a", "b", numeric.ratio(F.col("a"), F.col("b"), digits)).collect():
        assert found == (half_up(Fraction(a, b), digits) if b else None)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**15), st.integers(1, 10**12)), min_size=1, max_size=40))
def test_ratio_of_large_sums(spark, pairs):
    df = spark.createDataFrame([(a, b) for a, b in pairs if a // b < 10**14], "a long, b long")
    for a, b, found in df.select("a", "b", numeric.ratio(F.col("a"), F.col("b"), 2)).collect():
        assert found == half_up(Fraction(a, b), 2)


def test_percent_share_and_units(spark):
    row = spark.range(1).select(
        numeric.percent(F.lit(2), F.lit(3), 1).alias("p"), numeric.shifted(F.lit(-5), 2).alias("s"),
        numeric.in_units(F.lit(Decimal("12.34")), 2).alias("u")).first()
    assert (str(row.p), str(row.s), row.u) == ("66.7", "-0.05", 1234)


def test_deviation_of_one_value_is_null(spark):
    row = spark.range(1).select(numeric.sample_deviation(F.lit(1), F.lit(35), F.lit(1225), 3, 1).alias("d")).first()
    assert row.d is None


def test_rank_key_separates_close_means(spark):
    """1/3 and 333333/1000000 tie at five decimals; huge groups do not overflow."""
    row = spark.range(1).select(
        numeric.mean_rank_key(F.lit(1), F.lit(3)).alias("a"),
        numeric.mean_rank_key(F.lit(333333), F.lit(1000000)).alias("b"),
        numeric.mean_rank_key(F.lit(10**13), F.lit(2 * 10**11)).alias("c")).first()
    assert row.a > row.b and row.c == 50 * 10**16


@pytest.mark.parametrize("birth, as_of, age, crossed", [
    ("1980-07-01", "2001-06-30", 20, 21), ("1980-06-30", "2001-06-30", 21, 21), ("1980-01-01", "2001-06-30", 21, 21),
    ("1980-02-29", "2001-02-28", 21, 21), ("1980-02-29", "2001-02-27", 20, 21), ("2000-12-31", "2001-01-01", 0, 1)])
def test_years_between(spark, birth, as_of, age, crossed):
    first, last = F.to_date(F.lit(birth)), F.to_date(F.lit(as_of))
    row = spark.range(1).select(dates.complete_years(first, last), dates.calendar_years(first, last)).first()
    assert tuple(row) == (age, crossed)


def test_calendar(spark):
    days = calendar(spark, date(2023, 1, 1), date(2025, 12, 31))
    assert days.count() == 1096
    leap = days.filter("FechaKey = 20240229").first()
    assert (leap.Anio, leap.Semestre, leap.Trimestre, leap.Mes, leap.NombreMes, leap.Dia, leap.NombreDiaSemana) == (
        2024, 1, 1, 2, "Febrero", 29, "Jueves")
    english = calendar(spark, date(2023, 7, 1), date(2023, 7, 1), "en").first()
    assert (english.Semestre, english.NombreMes, english.NombreDiaSemana) == (2, "July", "Saturday")
    keys_of = days.select("FechaKey", "FechaCompleta").collect()
    assert all(row.FechaKey == int(row.FechaCompleta.strftime("%Y%m%d")) for row in keys_of)


def test_text(spark):
    none = F.lit(None).cast("string")
    row = spark.range(1).select(
        text.joined(F.lit("a"), "-", none, F.lit(7)), text.zero_filled(F.lit(5), 3), text.zero_filled(F.lit(1234), 3)).first()
    assert tuple(row) == ("a-7", "005", "234")


def test_defaults_fill_missing_values(spark):
    rows = spark.createDataFrame([(1, None), (2, False)], "EmpleadoID long, Activo boolean")
    filled = conformed(rows, SOURCE["Empleados"], F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    assert filled.columns == SOURCE["Empleados"].schema.names
    assert [row.Activo for row in filled.orderBy("EmpleadoID").collect()] == [True, False]
    assert filled.first().FechaCreacion is not None


def test_dense_keys(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("nk"), F.lit("x").alias("payload"))
    found = keys.dense_keys(rows, ["nk"], "k").orderBy("k").collect()
    assert [row.k for row in found] == list(range(1, 5001))
    assert [row.nk for row in found] == sorted(row.nk for row in found)


def test_dense_keys_of_many_rows(spark):
    large = keys.dense_keys(spark.range(20_000), ["id"], "k")
    assert large.filter("k <> id + 1").count() == 0 and large.count() == 20_000


def test_round_robin(spark):
    events = numbers_up_to(spark, 100).select((F.col("n") * 3).alias("event"))
    people = spark.createDataFrame([(10,), (30,), (20,)], "person long")
    found = {row.event: row.person for row in assign.round_robin(events, "event", people, "person").collect()}
    assert found == {3 * n: [10, 20, 30][(n - 1) % 3] for n in range(1, 101)}


def test_first_of_each(spark):
    rows = spark.createDataFrame([(1, 1, 5), (1, 1, 2), (1, 2, 9), (2, 1, 4), (2, 1, 3)], "a long, b long, n long")
    found = {tuple(row) for row in assign.first_of_each(rows, ["a", "b"], ["n"]).collect()}
    assert found == {(1, 1, 2), (1, 2, 9), (2, 1, 3)}


def test_managers(spark):
    members = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "id long, team string")
    found = {row.id: row.boss for row in assign.managers_of(members, "team", "id", "boss").collect()}
    assert found == {1: None, 3: 1, 2: None}


def test_builtin_cast_rounds_half_away_from_zero(spark):
    row = spark.range(1).select(F.lit(Decimal("0.25")).cast("decimal(5,1)"), F.lit(Decimal("-0.25")).cast("decimal(5,1)")).first()
    assert [str(v) for v in row] == ["0.3", "-0.3"]
    assert Decimal("0.25").quantize(Decimal("0.1"), ROUND_HALF_UP) == row[0]


def test_round_robin_spreads_evenly(spark):
    found = assign.round_robin(spark.range(1000), "id", spark.range(0, 70, 10).withColumnRenamed("id", "who"), "who")
    sizes = Counter(row.who for row in found.collect())
    assert sum(sizes.values()) == 1000 and max(sizes.values()) - min(sizes.values()) <= 1


def test_dense_keys_of_some_columns(spark):
    """What only orders the rows isn't written."""
    rows = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "nk int, value string")
    found = keys.dense_keys(rows, ["nk"], "k", ["value"])
    assert found.columns == ["k", "value"] and sorted(map(tuple, found.collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert "nk" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_dense_keys_with_columns_of_the_order(spark):
    """Columns that follow from others are computed after the shuffle, which carries what they are computed from."""
    rows = spark.createDataFrame([(3, 30.5), (1, None), (2, 20.5)], "nk int, value double")
    found = keys.dense_keys(rows, ["nk"], "k", [(F.col("nk") * 10).alias("ten"), F.col("value").cast("int").alias("whole"), "nk"])
    assert found.columns == ["k", "ten", "whole", "nk"]
    assert sorted(map(tuple, found.collect())) == [(1, 10, None, 1), (2, 20, 20, 2), (3, 30, 30, 3)]


def test_shuffles_fit_the_files(spark):
    """More partitions for large inputs, no larger merged ones; small inputs change nothing."""
    first, merged = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    session_ = spark.newSession()
    session_.conf.set("spark.sql.shuffle.partitions", "4")
    before = session_.conf.get(merged)
    session.fit_shuffles(session_, 30 << 20)
    assert session_.conf.get(first, None) is None and session_.conf.get(merged) == before
    session.fit_shuffles(session_, 800 << 20)
    assert session.shuffle_parts(session_) == 100 and session_.conf.get(merged) == str(16 << 20)
    session.fit_shuffles(session_, 80 << 20)
    assert session.shuffle_parts(session_) == 100
    session_.conf.set(merged, "8m")
    session.fit_shuffles(session_, 1600 << 20)
    assert session.shuffle_parts(session_) == 200 and session_.conf.get(merged) == str(8 << 20)
    assert keys.dense_keys(session_.range(1000), ["id"], "k").agg({"k": "max"}).first()[0] == 1000


def test_reads_fit_the_files(spark):
    """What a task reads of a large input, and sorts, doesn't grow with it; a smaller size that was asked for stays."""
    read = "spark.sql.files.maxPartitionBytes"
    session_ = spark.newSession()
    session_.conf.set("spark.sql.shuffle.partitions", "4")
    before = session_.conf.get(read)
    session.fit_shuffles(session_, 30 << 20)
    assert session_.conf.get(read) == before
    session.fit_shuffles(session_, 800 << 20)
    assert session_.conf.get(read) == str(16 << 20)
    session_.conf.set(read, "1m")
    session.fit_shuffles(session_, 1600 << 20)
    assert session_.conf.get(read) == str(1 << 20)


def test_bytes_of_tables(spark):
    sizes = [Path(f"{SMALL}/{name}.parquet").stat().st_size for name in ("orders", "part")]
    assert storage.stored_bytes(spark, SMALL, ("orders", "part")) == sum(sizes)
