"""Mixing (op11), source divergence (op12) and centroid clusters (op13) against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from peoplemart.llm import centroids, divergence, mixing
from tests.llm import cases

CLASHING = "size int, hash string, copies string, taken int, words int, n string, p int, path string, cluster string, v int"
CLASHES = (1, "h", "c", 2, 3, "n", 4, "p", "x", 5)


def documents(spark, rows, schema="doc_id long, text string, lang string, source string"):
    return spark.createDataFrame([(*row, *CLASHES) for row in rows], f"{schema}, {CLASHING}")


def awkward_documents():
    rng = random.Random(3)
    sources = ["b", "a", "ä", "", None, "\U0001f642", "z"]
    rows = [(i, text, rng.choice(["en", "de", None, ""]), rng.choice(sources)) for i, text in cases.awkward_texts()]
    rows += [(200 + i, cases.sentence(rng, rng.randint(0, 60), 40), "en", "a" if i % 3 == 0 else rng.choice(sources)) for i in range(240)]
    return rows + rows[-2:]


def target_words(rows, share=100):
    """source -> size and exact target."""
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(cases.words(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    rest, left, target = Fraction(sum(sizes.values()) * share // 100), set(order), {}
    while True:
        even = rest / max(1, sum(weight[s] for s in left))
        full = {s for s in left if even * weight[s] > 3 * sizes[s]}
        if not full:
            return {s: (sizes[s], target.get(s, even * weight[s])) for s in order}
        for s in full:
            target[s] = Fraction(3 * sizes[s])
            rest -= target[s]
        left -= full


def test_mix_is_near_its_targets(spark):
    rows = awkward_documents()
    found = mixing.mix(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len(cases.words(t))) for i, t, *_ in rows)
    expected, taken, longest = target_words(rows), Counter(), defaultdict(int)
    for row in found:
        size, target = expected[row.source]
        assert row.source_size == size and row.target == pytest.approx(float(target), rel=1e-12)
        assert row.taken == row.copies * row.size and 0 <= row.copies <= 3
        taken[row.source] += row.taken
    same = Counter((i, t, s) for i, t, _, s in rows)
    for (_, t, s), n in same.items():
        longest[s] = max(longest[s], n * len(cases.words(t)))
    for source, (_, target) in expected.items():
        assert abs(taken[source] - target) <= longest[source] / 2 + 1


def test_mix_agrees_with_sorting_by_hash(spark):
    """The thresholds found bucket by bucket are those of running sums over all documents."""
    rows = awkward_documents()
    plan = mixing.mix(documents(spark, rows)).collect()
    for source in {r.source for r in plan}:
        own = sorted((r for r in plan if r.source == source), key=lambda r: r.hash)
        total = own[0].source_size
        goal = math.floor(Fraction(target_words(rows)[source][1]) + Fraction(1, 2))
        passes, budget = divmod(goal, total) if total else (0, 0)
        sums = Counter()
        for r in own:
            sums[r.hash] += r.size
        upto, below = 0, {}
        for h in sorted(sums):
            below[h] = upto + sums[h] <= budget or upto <= budget and upto + sums[h] - budget < budget - upto
            upto += sums[h]
        for r in own:
            assert r.size == 0 or r.copies == passes + below[r.hash]


def test_mixes_are_nested_and_rerun_alike(spark):
    rows = awkward_documents()
    docs = documents(spark, rows)
    small, large = (Counter({(r.doc_id, r.hash): r.copies for r in mixing.mix(docs, share=share).collect() if r.size}) for share in (40, 90))
    assert small and all(large[k] >= n for k, n in small.items())
    random.Random(1).shuffle(rows)
    again = mixing.mix(documents(spark, rows).repartition(5))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, mixing.mix(docs).collect()))
    full = mixing.mix(docs, share=300).collect()
    assert all(r.copies == 3 for r in full if r.size)


def test_mix_of_little(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    only = mixing.mix(documents(spark, [(1, None, None, None), (None, "", None, "a")])).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in only} == {(1, 0, 0, 0.0, 0), (None, 0, 0, 0.0, 0)}
    docs = documents(spark, [(1, "a b", None, "s"), (2, "c", None, "t")])
    found = mixing.mix(docs)
    assert {(r.doc_id, r.target, r.taken) for r in found.collect()} == {(1, 1.0, 0), (2, 2.0, 2)}
    texts = mixing.expanded(docs, found)
    assert [(r.doc_id, r.text, r["copy"]) for r in texts.orderBy("copy").collect()] == [(2, "c", 1), (2, "c", 2)]
    assert texts.columns == [*docs.columns, "copy"]


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL_LETTERS = {c: c + 32 for c in range(65, 91)}


def plain_audit(rows, least):
    counts, documents_with = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = [t.translate(SMALL_LETTERS) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        documents_with[lang or ""].update(set(terms))
    out = []
    for lang in documents_with:
        kept = [t for t, n in documents_with[lang].items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}

        def share(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        whole = share(sum(groups.values(), Counter()))
        shares = {s: share(c) for s, c in groups.items()}
        for s, p in shares.items():
            pair = [(sum(abs(p[t] - q[t]) for t in kept), o) for o, q in shares.items() if o != s]
            term = [(p[t] - whole[t], t) for t in kept if groups[s][t] > 0 and p[t] > whole[t]]
            for part, found in (("pair", pair), ("term", sorted(term, key=lambda x: (-x[0], x[1].encode()))[:50])):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    out.append((lang, s, part, item, value, rank))
    return Counter(out)


@pytest.mark.parametrize("least", [1, 3, 30])
def test_audit_agrees_with_all_pairs(spark, least, monkeypatch):
    monkeypatch.setattr(divergence, "MOST_TERMS", 50)
    monkeypatch.setattr(divergence, "MOST_SOURCES", 3)
    rows = awkward_documents() + [(900, "ÀÉ àé STRASSE straße x_y-z 12", "en", "a"), (901, "only here", "fr", None)]
    found = divergence.audit(documents(spark, rows), least_documents=least)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == plain_audit(rows, least)


def test_audit_of_little(spark):
    assert divergence.audit(documents(spark, [])).count() == 0
    found = divergence.audit(documents(spark, [(1, None, None, "a"), (2, "", None, None), (3, "x", "en", "a")]))
    assert sorted(map(tuple, found.collect())) == [("", "", "pair", "a", 0, 1), ("", "a", "pair", "", 0, 1)]


def test_terms_of_one_path_are_one_walk(spark):
    """Terms with equal counts in the same sources are one row of the tree, with their number."""
    path = [("a", 1, 9, 4), ("b", 2, 8, 5), ("c", 1, 20, 6)]
    rows = [("en", path, 7), ("en", path[:2], 3), ("de", path[1:], 1)]
    paths = spark.createDataFrame(rows, "lang string, path array<struct<source:string,n:long,p:long,base:long>>, terms long")
    found = {tuple(r)[:3]: r.correction for r in divergence.corrections(paths, 3).collect()}
    assert found == {("en", "a", "b"): -2 * 10 * 3, ("en", "a", "c"): -2 * 7 * 3, ("en", "b", "c"): -2 * 7 * 2, ("de", "b", "c"): -4}


def plain_clusters(rows, clusters, rounds, dimensions):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroid = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroid))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        for k, vectors in own.items():
            centroid[k] = [sum(column) // len(vectors) for column in zip(*vectors, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, k, d in found:
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroid]
    return Counter((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for i, k, d in found)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(*row, *CLASHES) for row in rows], f"vec_id long, embedding array<{kind}>, {CLASHING}")


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_clusters_agree_with_plain_rounds(spark, block):
    rng = random.Random(7)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 0.2)]) for _ in range(7)]) for i in range(160)]
    rows += [(500, None), (501, []), (502, [0.1] * 6), (503, [0.1] * 6 + [None]), (504, [math.nan] + [0.0] * 6), (505, [math.inf] + [0.0] * 6),
             (None, [0.5] * 7), (3, rows[3][1]), (3, [0.0] * 7), (506, [-0.001] * 7), (507, [1e5] * 7)]
    found = centroids.clustered(vectors(spark, rows, "double"), clusters=12, rounds=4, dimensions=7, block=block)
    assert Counter(map(tuple, found.collect())) == plain_clusters(rows, 12, 4, 7)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-1.0] * 64)]
    found = centroids.clustered(vectors(spark, rows))
    assert Counter(map(tuple, found.collect())) == plain_clusters(rows, 40, 5, 64)
    assert centroids.clustered(vectors(spark, [])).count() == 0
    assert centroids.clustered(vectors(spark, [(1, None)])).count() == 0
    far = centroids.clustered(vectors(spark, [(1, [3e38] * 64), (2, [-3e38] * 64)])).collect()
    assert {r.distance for r in far} == {0}


def test_dictionaries_lose_nothing():
    rows = np.random.default_rng(1).integers(-3, 3, (200, 3)).astype(np.int32)
    codes, words = centroids.dictionary(rows)
    assert (words[codes] == rows).all() and len(words) == len(np.unique(rows, axis=0))
