"""Nearest neighbours against all distances."""

import numpy as np

from peoplemart.llm import forest
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, shard string, v int, ids string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "s", 1, "i", 2) for i, v in rows], SCHEMA)


def nearest(rows, query, n=10):
    own = np.array(next(v for i, v in rows if i == query), np.float32).astype(float)
    found = [(float(np.sqrt(((np.array(v, np.float32).astype(float) - own) ** 2).sum())), i) for i, v in rows if i != query and len(v) == len(own)]
    return sorted(found)[:n]


def test_recall(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = {}
    for r in forest.search(vectors, vectors.filter("vec_id % 25 = 0"), share=0.4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for query, found in got.items():
        expected = nearest(rows, query)
        assert [r for r, *_ in sorted(found)] == list(range(1, 11))
        hits += len({i for _, i, _ in found} & {i for _, i in expected})
    assert len(got) == 20 and hits >= 0.9 * 200


def test_candidates_share_the_longest_prefixes():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((400, 8))
    own = forest.Forest(points, trees=4, bits=10)
    strings, asked = own.hashed(points), rng.standard_normal((5, 8))
    for text, rows in zip(own.hashed(asked), own.candidates(asked, 40), strict=True):
        shared = np.array([[next((b for b in range(10) if (x ^ y) >> (9 - b) & 1), 10) for x, y in zip(s, text, strict=True)] for s in strings]).max(1)
        level = max(x for x in range(11) if (shared >= x).sum() >= 40)
        assert set(np.flatnonzero(shared >= level)) == set(rows)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(30)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # ties and copies
    rows += [(300, [1.0, 2.0]), (301, [1.0, 3.0])]  # of another length
    odd = [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 1.0, 1.0, 1.0]),
           (204, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (205, [])]
    vectors = frame(spark, rows + odd + [rows[0], rows[0]])
    got = {}
    for r in forest.search(vectors, vectors.filter("vec_id % 3 = 0"), shard_rows=25).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i, _ in rows if i % 3 == 0}
    for query, found in got.items():
        assert [(s, i) for _, i, s in sorted(found)] == nearest(rows, query), query
    assert len(got[300]) == 1
    none = vectors.filter("vec_id < 0")
    assert forest.search(none, none).count() == 0 and forest.search(vectors, none).count() == 0
