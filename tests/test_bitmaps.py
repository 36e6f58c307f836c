"""Keys as bitmaps: membership, distinct counts, and the plans they make."""

import random

import pytest
from pyspark.sql import functions as F

from peoplemart.operators import bitmaps, references
from peoplemart.operators.references import lost, reference_profile
from peoplemart.plans import kpis, quality
from peoplemart.sources.schemas import MART, Reference
from tests.people import CALENDAR_END, CALENDAR_START
from tests.test_scale import conf, plan_of  # noqa: F401

EDGES = [0, 1, 2, 7, 8, 9, 63, 64, 65, 32_767, 32_768, 32_769, 65_536, 65_537, -1, -2, -32_768, -32_769, 2**40, 2**62]


class Dense(dict):
    """Parents whose keys lie in a known range."""

    def key_range(self, name, column):
        return -2**17, 2**17


def keys_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


def test_every_bit_is_found(spark):
    rng = random.Random(1)
    held = [v for v in EDGES if v % 2 == 0] + [rng.randrange(100_000) * 2 for _ in range(3000)] + [None]
    asked = EDGES + list(range(-40, 40)) + [rng.randrange(200_000) for _ in range(3000)] + [None]
    known = bitmaps.known_keys(keys_of(spark, held), "k")
    rows = keys_of(spark, asked).join(known, bitmaps.bucket_of("k") == F.col("_bucket"), "left")
    found = rows.select("k", F.expr(bitmaps.is_in("_words", "k")).alias("there")).collect()
    assert len(found) == len(asked)
    assert all(row.there == (row.k is not None and row.k in set(held)) for row in found)


@pytest.mark.parametrize("kind", ["int", "long"])
def test_bitmaps_and_values_agree(spark, kind):
    rng = random.Random(2)
    child = spark.createDataFrame([(rng.choice([None, -7, rng.randrange(70_000)]), rng.randrange(90)) for _ in range(5000)], f"a {kind}, b {kind}")
    parents = {"A": spark.range(0, 70_000, 3).select(F.col("id").cast(kind).alias("k")).unionAll(spark.range(9).select(F.col("id").cast(kind))),
               "B": spark.range(80).select(F.col("id").cast(kind).alias("k"))}
    asked = [Reference("a", "A", "k"), Reference("b", "B", "k"), Reference("b", "A", "k")]
    by_bitmaps = reference_profile(child, asked, Dense(parents), {"many": F.col("b") > 50})
    by_values = reference_profile(child, asked, parents, {"many": F.col("b") > 50})
    assert "bitmap" in plan_of(by_bitmaps) and "bitmap" not in plan_of(by_values)
    assert by_bitmaps.first() == by_values.first() and by_bitmaps.first()[lost(0)] > 0
    empty = Dense({name: parent.limit(0) for name, parent in parents.items()})
    assert reference_profile(child, asked, empty, {}).first().Huerfanas == 5000
    assert reference_profile(child.limit(0), asked, Dense(parents), {}).first()[:2] == (0, 0)


@pytest.mark.parametrize("fact", ["FactAusencias", "FactEvaluaciones", "FactCapacitaciones"])
def test_no_fact_row_is_shuffled_for_its_references(mart, conf, fact):  # noqa: F811
    """Though no parent may be broadcast, the rows reach their count without an exchange."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    profile = reference_profile(mart[fact], MART[fact].references, mart, {})
    lines = plan_of(profile).splitlines()
    assert not any("SortMergeJoin" in line or "ShuffledHashJoin" in line for line in lines)
    assert sum("BroadcastHashJoin" in line for line in lines) == len(MART[fact].references)
    # what is exchanged: the bitmaps of the parents, and one row of counts per task
    exchanged = [line for line in lines if " Exchange " in line]
    assert all("_bucket" in line or "SinglePartition" in line for line in exchanged)
    row = profile.first()
    assert row.Filas == mart[fact].count() and row.Huerfanas == 0


def test_wide_ranges_take_the_other_way(mart, conf, monkeypatch):  # noqa: F811
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    wanted = [1, 2, 3]
    before = sorted(map(tuple, quality.verdicts(mart, mart.source, CALENDAR_START, CALENDAR_END, wanted).collect()))
    monkeypatch.setattr(references, "MOST_BITMAP_BYTES", 0)
    other = quality.verdicts(mart, mart.source, CALENDAR_START, CALENDAR_END, wanted)
    assert "SortMergeJoin" in plan_of(other) and sorted(map(tuple, other.collect())) == before


def test_replaced_parents_lose_their_range(mart):
    lacking = mart.replaced(DimEmpleado=mart["DimEmpleado"].filter("EmpleadoKey > 3"))
    assert mart.key_range("DimEmpleado", "EmpleadoKey") == (1, 50) and mart.replaced().key_range("DimEmpleado", "EmpleadoKey") == (1, 50)
    assert lacking.key_range("DimEmpleado", "EmpleadoKey") is None and lacking.key_range("DimOficina", "OficinaKey") == (1, 5)
    assert mart.key_range("DimEmpleado", "EmpleadoID_OLTP") is None and mart.key_range("FactAusencias", "FactAusenciaKey") is None
    row = reference_profile(mart["FactAusencias"], MART["FactAusencias"].references, lacking, {}).first()
    assert row.Huerfanas == mart["FactAusencias"].filter("EmpleadoKey <= 3").count() > 0


def test_distinct_keys_merge_over_parts(spark):
    """Bitmaps of years, saved once, give the counts of any span of years."""
    rng = random.Random(5)
    rows = [(rng.randrange(2001, 2005), rng.choice(["a", "b", None]), rng.choice([None, 1, rng.randrange(99_000)])) for _ in range(4000)]
    events = spark.createDataFrame(rows, "y int, g string, k long")
    parts = bitmaps.member_bitmaps(events, ["y", "g"], "k", F.count("*").alias("n"))
    for years in ((2001, 2004), (2002, 2003), (2007, 2008)):
        merged = bitmaps.merged_bitmaps(parts.filter(F.col("y").between(*years)), ["g"], F.sum("n").alias("n"))
        found = bitmaps.member_counts(merged, ["g"], "people", F.sum("n").alias("n"))
        own = events.filter(F.col("y").between(*years)).groupBy("g").agg(F.count_distinct("k").alias("people"), F.count("*").alias("n"))
        assert sorted(map(str, found.collect())) == sorted(map(str, own.collect()))
    total = bitmaps.member_counts(parts, ["y", "g"], "people", F.sum("n").alias("n"))
    assert sorted(map(str, total.collect())) == sorted(map(str, events.groupBy("y", "g").agg(
        F.count_distinct("k").alias("people"), F.count("*").alias("n")).collect()))


@pytest.mark.parametrize("name", ["q03", "q05", "q07", "q08", "q14"])
def test_distinct_employees_travel_as_bitmaps(mart, conf, name):  # noqa: F811
    """No exchange is dealt by employee: the fold on the map side leaves a row per group and bucket."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    lines = plan_of(kpis.KPIS[name](mart)).splitlines()
    aggregates = [line for line in lines if "partial_bitmap_construct_agg" in line]
    assert len(aggregates) == 1 and "_bucket" in aggregates[0].split("functions=")[0]
    assert not any("distinct" in line for line in lines)
    assert not any("Exchange" in line and "EmpleadoKey" in line.split("ENSURE")[0] for line in lines)
