"""Every registered query against its SQL in a second engine."""

import pytest

import __spark_entry__ as registered
from tests.conftest import SMALL
from verification.compare import compare
from verification.oracle import oracle_statements

NAMES = list(registered.library_queries())


def test_every_query_has_sql():
    assert sorted(NAMES) == sorted(oracle_statements())
    assert set(NAMES) <= set(registered.queries())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, name):
    assert compare(spark, SMALL, [name]) == []


def test_entry(spark):
    assert registered.entry(spark).count() == 5


def test_checks_find_the_faults(spark):
    """Over the faulty tables every check has something to find; a short calendar fails without a number."""
    queries = registered.library_queries()
    for number in range(1, 15):
        row = queries[f"v{number:02}_faults"](spark, SMALL).first()
        assert row.Estado == "FAIL" and (row.Problemas > 0) == (number != 12), number
    for name in (n for n in NAMES if n.startswith("c") and n.endswith("_faults")):
        assert queries[name](spark, SMALL).groupBy().sum("Problemas").first()[0] > 0, name
    for name in ("a16_repeated_ids", "c04_orphans", "c07_breaking"):
        assert queries[name](spark, SMALL).count() > 0
