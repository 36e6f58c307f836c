"""Operators that count over the corpus: repeated passages, backoff scores, near-duplicates."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from peoplemart.llm import common, exchange, ngram_scores, simhash, substrings
from peoplemart.llm.components import components
from tests.llm import cases


def without_repeats(rows, size):
    """(id, words, removed, digest of what stays), by every window of every text."""
    first = {}
    for i, text in rows:
        own = cases.words(text)
        for k in range(len(own) - size + 1) if i is not None else ():
            gram = tuple(own[k: k + size])
            first[gram] = min(i, first.get(gram, i))
    out = []
    for i, text in rows:
        own = cases.words(text)
        covered = [False] * len(own)
        for k in range(len(own) - size + 1) if i is not None else ():
            if first[tuple(own[k: k + size])] < i:
                covered[k: k + size] = [True] * size
        kept = " ".join(w for w, c in zip(own, covered, strict=True) if not c)
        out.append((i, len(own), sum(covered), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("size", [2, 13])
def test_repeated_passages(spark, monkeypatch, size):
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 20_000)  # several blocks
    rows = cases.awkward_texts()
    found = substrings.without_repeats(cases.frame(spark, rows), window=size)
    assert {"block", "row", "key", "c0", "half"} <= set(found.columns)
    got = found.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "block").collect()
    assert Counter(tuple(r)[:4] for r in got) == without_repeats(rows, size)
    assert all(r.block == 7 for r in got)
    for r in got:
        assert r.n_removed or r.kept_text in {text or "" for i, text in rows if i == r.doc_id}


def test_prefilter_loses_nothing_when_full(spark):
    """A sketch of few cells counts nearly everything as repeated; the result stays the same."""
    rows = cases.awkward_texts()
    found = substrings.without_repeats(cases.frame(spark, rows), cells_per_byte=1e-6, depth=1)
    got = Counter(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == without_repeats(rows, 13)


def test_order_of_a_blocks_rows_does_not_matter():
    """A shuffle read again delivers the rows of a block in another order."""
    rng = random.Random(5)
    shared = [cases.sentence(rng, 30, 500) for _ in range(4)]
    rows = [(i if i % 9 else None, f"{cases.sentence(rng, rng.randint(0, 40), 500)} {shared[i % 4]}") for i in range(40)] + [(3, shared[1]), (3, shared[1]), (5, "")]

    def block():
        rng.shuffle(rows)
        return pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [text for _, text in rows],
                         "row": [{"doc_id": i} for i, _ in rows]})

    sketch = substrings._Sketch(2, 16, 3, 13)
    groups = substrings._Groups(sketch, 3)
    sent = dict(sketch.ask(block()))
    answers = {s: sketch.reply([payload])[0] for s, payload in sent.items()}
    answers = {s: groups.reply([payload])[0] for s, payload in groups.ask(block(), answers)}
    for _ in range(3):
        found = groups.finish(block(), answers).to_pylist()
        got = Counter((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found)
        assert got == without_repeats(rows, 13) and any(r["n_removed"] for r in found)


def test_one_row_for_hot_windows(spark):
    """A passage in most documents is sent once per block."""
    rows = [(i, "the same words in every text are here again and again for all of us " + cases.sentence(random.Random(i), 20))
            for i in range(2000)]
    docs = cases.frame(spark, rows)
    blocked = exchange.in_blocks(docs, "doc_id", "text", 4)
    sketch = substrings._Sketch(1, 20, 1, 13)
    sizes = [len(r.payload) for r in exchange.sent(blocked, sketch.ask).collect()]
    assert len(sizes) == 4
    got = substrings.without_repeats(docs).filter("n_removed > 0").count()
    assert got == 1999


def test_empty_tables(spark):
    none = cases.frame(spark, [(1, "x")]).filter("doc_id > 1")
    assert substrings.without_repeats(none).count() == 0
    assert ngram_scores.scored(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    nulls = cases.frame(spark, [(None, None), (1, None)])
    assert [r.n_words for r in substrings.without_repeats(nulls).collect()] == [0, 0]
    assert [r.score for r in ngram_scores.scored(nulls).collect()] == [None, None]


def scores(rows, order, backoff=0.4):
    texts = [cases.words(t) for _, t in rows]
    grams = lambda w: Counter(tuple(w[i: i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total, every = Counter(), sum(map(len, texts))
    for w in texts:
        total.update(grams(w))
    for w in texts:
        own, logs = grams(w), 0.0
        for k in range(len(w)):
            longest = min(order, k + 1)
            for n in range(longest, 0, -1):
                gram = tuple(w[k - n + 1: k + 1])
                seen = total[gram] - own[gram]
                if n == 1:
                    logs += math.log(backoff ** (longest - 1) * max(1, seen) / max(1, every - len(w)))
                elif seen:
                    logs += math.log(backoff ** (longest - n) * seen / max(1, total[gram[:-1]] - own[gram[:-1]]))
                    break
        yield len(w), logs / len(w) if w else None


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(spark, monkeypatch, order):
    monkeypatch.setattr(ngram_scores, "BLOCK_BYTES", 20_000)  # several blocks
    rows = cases.awkward_texts()
    got = ngram_scores.scored(cases.frame(spark, rows), order=order).select("doc_id", "n_words", "score").collect()
    key = lambda x: (str(x[0]), x[1], x[2] or 0)
    expected = sorted(((i, n, s) for (i, _), (n, s) in zip(rows, scores(rows, order), strict=True)), key=key)
    for mine, theirs in zip(sorted(map(tuple, got), key=key), expected, strict=True):
        assert mine[:2] == theirs[:2] and mine[2] == pytest.approx(theirs[2], abs=1e-9)


def test_a_frequent_pair_is_one_row_of_a_block(spark):
    """The n-grams' rows are shuffled once, and a pair of words that all texts have is a row per block."""
    rows = [(i, "of the " * 30 + cases.sentence(random.Random(i), 5)) for i in range(2000)]
    blocked = exchange.in_blocks(cases.frame(spark, rows), "doc_id", "text", 4)
    grams = ngram_scores.n_grams(blocked, 2)
    per_gram = grams.groupBy("gram").count().agg({"count": "max"}).first()[0]
    assert per_gram == 4
    totals = ngram_scores.answered(grams, 4)
    assert totals.agg({"others": "max"}).first()[0] > 0
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(gram") == 2 and plan.count("hashpartitioning(counted") == 0
    totals.collect()
    assert "ReusedExchange" in totals._jdf.queryExecution().executedPlan().toString()


def shuffled_rows(df):
    """The rows that all shuffles of df write."""
    df.collect()
    plans, found = [df._jdf.queryExecution().executedPlan().executedPlan()], 0
    while plans:
        plan = plans.pop()
        if plan.nodeName().endswith("QueryStage"):
            plan = plan.plan()
        if plan.nodeName() == "Exchange":
            found += plan.metrics().apply("shuffleRecordsWritten").value()
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_n_grams_are_shuffled_as_lists(spark, monkeypatch):
    """A row of the shuffles is a text, or a block's n-grams of one range of hashes; a row per n-gram takes too much disk."""
    monkeypatch.setattr(ngram_scores, "BLOCK_BYTES", 20_000)
    rows = [(i, cases.sentence(random.Random(i), 20)) for i in range(500)]
    blocks, ranges = common.pieces(sum(len(t) for _, t in rows), 20_000), 4
    found = ngram_scores.scored(cases.frame(spark, rows))
    assert blocks > 1 and len(rows) < shuffled_rows(found) <= len(rows) + 2 * blocks * ranges


def test_repeated_rows_without_an_id_share_blocks(spark):
    """Rows that are equal in all columns are dealt by where they are read."""
    docs = cases.frame(spark, [(None, "a b c")] * 400).repartition(8)
    blocked = exchange.in_blocks(docs, "doc_id", "text", 8)
    assert blocked.select("block").distinct().count() > 1
    got = ngram_scores.scored(docs).collect()
    assert len(got) == 400 and len({(r.n_words, round(r.score, 9)) for r in got}) == 1


def plain_fingerprint(text, shingle=3):
    own = cases.words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(own[i: i + shingle]) for i in range(len(own) - shingle + 1)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(values, distance=2):
    """The smallest index each fingerprint reaches."""
    array = np.array(values, np.uint64)
    root = np.arange(len(array))
    near = [np.flatnonzero(np.bitwise_count(v ^ array) <= distance) for v in array]
    while True:
        least = np.array([root[n].min() for n in near])
        least = np.minimum(least, least[least])
        if (least == root).all():
            return root.tolist()
        root = least


def test_near_duplicates(spark):
    rows = cases.awkward_texts()
    got = simhash.near_duplicates(cases.frame(spark, rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    members = defaultdict(list)
    for (i, _), g in zip(rows, grouped(prints), strict=True):
        members[g] += [i] if i is not None else []
    expected = Counter((i, p, min(members[g], default=None)) for (i, _), p, g in zip(rows, prints, grouped(prints), strict=True))
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == expected
    copies = {r.doc_id: r.component_id for r in got if r.doc_id in (10, 12, 13)}
    assert copies[12] == copies[10] and copies[13] == 13


@pytest.mark.parametrize("most", [2048, 20, 3])
def test_links_of_crowded_halves(spark, most):
    """Fingerprints around few centres, met in few values of a half: cut again, none is lost."""
    rng = np.random.default_rng(3)
    values = {int(x) for x in rng.integers(0, 2**63, 3)}
    for centre in list(values):
        for _ in range(150):
            values.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)))
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, most)
    root = {r.node: r.root for r in components(links).collect()}
    got, expected = [root.get(v, v) for v in signed], grouped(values)
    assert len(set(zip(got, expected, strict=True))) == len(set(got)) == len(set(expected))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(5, 5), (7, 6), (1000, 999)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(201)} | {999: 999, 1000: 999}
    assert components(links.filter("a = b")).count() == 0
