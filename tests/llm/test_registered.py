"""The registered queries against their SQL, and the pipeline stage by stage."""

import hashlib

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from peoplemart.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm import cases
from tests.llm.test_counting import scores, without_repeats
from verification.compare import compare


def test_all_and_the_pipeline():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_same_rows(spark, name):
    assert compare(spark, SMALL, [name]) == []


def test_longer_contexts_are_registered(spark):
    """Scores by up to three words in a row, held against plain Python."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = registered.queries()["op9_lm_scores_longer"](spark, SMALL).collect()
    expected = sorted((i, n, s) for (i, _), (n, s) in zip(rows, scores(rows, 3), strict=True))
    assert [(i, n) for i, n, _ in sorted(map(tuple, got))] == [(i, n) for i, n, _ in expected]
    assert [s for *_, s in sorted(map(tuple, got))] == pytest.approx([s for *_, s in expected], abs=2e-6)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, SMALL)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(given)
    odd = spark.createDataFrame([(900, None, None, None, 0), (901, "12 34", None, None, 5)], docs.schema)
    assert stages["language_id"](spark, docs.unionAll(odd), SMALL).filter("doc_id >= 900").count() == 0
    copies = docs.unionAll(docs.selectExpr("doc_id + 1000", "text", "lang", "source", "n_chars"))
    single = stages["near_dedup"](spark, copies, SMALL)
    assert single.count() == stages["near_dedup"](spark, docs, SMALL).count() < 200 and single.filter("doc_id >= 1000").count() == 0
    shorter = {r.doc_id: r.text for r in stages["substring_dedup"](spark, docs, SMALL).collect()}
    plain = {i: digest for i, _, _, digest in without_repeats(list(given.items()), 13)}
    assert {i: hashlib.sha256(" ".join(cases.words(t)).encode()).hexdigest() for i, t in shorter.items()} == plain
    told = spark.createDataFrame([(902, "a password: Abc12345 b", None, None, 22)], docs.schema)
    clean = stages["secret_scan"](spark, docs.unionAll(told), SMALL)
    assert clean.filter("doc_id = 902").first()[:2] == (902, "a [secret] b") and clean.columns == docs.columns
    again = stages["secret_scan"](spark, clean, SMALL)
    assert sorted(r.text for r in again.collect()) == sorted(r.text for r in clean.collect())
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 100 and out.filter("n_words > bucket").count() == 0
