"""Stages of the pipeline that do more than their operator's query."""

import math
import random
from collections import Counter
from zlib import crc32

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from peoplemart.llm import language, simhash
from tests.conftest import SMALL
from tests.llm import cases

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in rows], SCHEMA)


def bits(text):
    """The fingerprint of op6's contract, as plain Python."""
    own = cases.words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    grams = [" ".join(own[i: i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_one_document_of_each_group_stays(spark):
    """Against all pairs of fingerprints; repeated ids, ids that are missing, copies, empty and NULL texts."""
    rng = random.Random(8)
    rows = [(7, None), (3, ""), (None, ""), (None, "only here and nowhere else"), (12, "some words"), (12, "some words"), (12, "other words")]
    for k in range(40):
        own = cases.sentence(rng, rng.randint(60, 900), 5000).split()
        rows += [(100 * k + 50, " ".join(own)), (100 * k + 20, " ".join(own).upper())]
        for c in range(1, 8):
            changed = list(own)
            changed[rng.randrange(len(own))] = f"new{c}"
            rows.append((100 * k + 50 + c, " ".join(changed)))
    rng.shuffle(rows)
    prints = [bits(text or "") for _, text in rows]
    root = list(range(len(rows)))
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert any(prints[a] != prints[b] for a, b in near)
    changed = True
    while changed:
        changed = False
        for a, b in near:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    least = {}
    for (i, text), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, (True, 0)), (i is None, i or 0))
    kept = STAGES["near_dedup"](spark, frame(spark, rows).repartition(6), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = Counter(r.doc_id for r in kept.collect())
    assert got == Counter(None if none else i for none, i in least.values()) and got[12] == 2
    assert STAGES["near_dedup"](spark, frame(spark, []), "").count() == 0


def test_all_columns_of_the_rows_that_stay(spark):
    found = simhash.first_of_groups(cases.frame(spark, cases.awkward_texts()))
    assert found.columns == cases.frame(spark, []).columns and {r.row for r in found.collect()} == {"x"}


@pytest.mark.parametrize("labels", [["en", "de", "fr", "es"], ["en", "de"]])
def test_texts_of_no_learned_language_go(spark, labels):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter(F.col("lang").isin(labels))
    rng = random.Random(1)
    letters = lambda signs, n: "".join(rng.choice(signs) for _ in range(n))
    odd = [" ".join(letters("bcdfghjklmnpqrstvwxz", rng.randint(2, 10)) for _ in range(60)),
           "девочка идет через лес и видит большую птицу которая летит над деревьями к воде",
           "dziewczyna idzie przez las i widzi wielkiego ptaka który leci nad drzewami w stronę wody"]
    rows = docs.unionAll(frame(spark, [(10**6 + i, t) for i, t in enumerate(odd)]))
    kept = {r.doc_id for r in STAGES["language_id"](spark, rows, SMALL).collect()}
    clean = {r.doc_id for r in docs.collect()}
    print(labels, sorted(i for i in kept if i >= 10**6), len(clean - kept))
    assert len(clean - kept) <= 0.01 * len(clean)
    if len(labels) == 4:
        assert kept <= clean
    network = language.trained(*language.sample(docs, "doc_id", "text", "lang"))
    assert 1 / len(labels) + 0.1 < corpus_pipeline.least_language_score(network, docs) < 0.95


def test_least_score_is_of_all_held_out_rows(spark, monkeypatch):
    """13,340 held-out rows, of which a fifth was read before."""
    monkeypatch.setattr(language, "identified_by", lambda network, docs, text_col="text": docs.withColumn(
        "lang_pred", F.lit("en")).withColumn("score", F.pmod(F.col("doc_id") * 7919, F.lit(40009)) / 40009))
    docs = spark.range(40000).selectExpr("id AS doc_id", "'x' AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    held = sorted(i * 7919 % 40009 / 40009 for i in range(40000) if crc32(str(i).encode()) % 3 == 1)
    usual = held[math.ceil(0.01 * len(held)) - 1]
    network = language.Network.__new__(language.Network)
    network.labels = ["de", "en"]
    assert corpus_pipeline.least_language_score(network, docs) == pytest.approx(0.5 + 0.6 * (usual - 0.5), abs=1e-12)


def test_score_of_rank(spark):
    values = [0.0, 1.0, 1.0, 0.25, 0.25 + 1e-7, 0.25 + 2e-7, 0.5]
    scored = spark.createDataFrame([(v,) for v in values * 3], "score double")
    for share in (0.01, 0.2, 0.3, 0.4, 0.5, 0.9, 1.0):
        assert corpus_pipeline.score_of_rank(scored, share) == sorted(values * 3)[math.ceil(share * 21) - 1]
    assert corpus_pipeline.score_of_rank(scored.limit(0), 0.5) is None
