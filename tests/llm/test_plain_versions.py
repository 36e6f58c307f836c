"""Registered queries against plain versions over whole documents: secrets (op10), languages (op7); stages on little."""

import hashlib
import math
import re

import numpy as np
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from peoplemart.llm import language, secret_scan
from tests.conftest import SMALL
from tests.llm import cases

#: The base patterns of op10's contract and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(*m.span(), "hex") for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[0], ["assign", "access", "hex"].index(s[2])))


def joined(spans) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


SECRETS = ["PASSWORD = 'abcdef'", "my_token:x=12345678", "api_key\"  :  \"Zz+/=_.-Zz", "apikey=12345", "ſecret=abcdefgh tokeK=abcdefgh", "é secret\n=abcdef",
           "AKIA" + "Z9" * 8, "AKIA" + "Z9" * 7 + "Z", "a" * 24 + " " + "0f" * 11 + "0", "secret=" + "ab12" * 8 + " AKIAAKIA" + "Q" * 16, "passwd: AKIA" + "7" * 16]


def test_base_spans_of_all_documents(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")  # the smallest table with secrets
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = registered.queries()["op10_secret_scan"](spark, folder).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(got) == len(texts)
    extra = [(10**6 + i, text) for i, text in enumerate([*SECRETS, "\n".join(SECRETS), *(t for _, t in cases.awkward_texts())])]
    got += secret_scan.secrets(cases.frame(spark, extra)).collect()
    texts |= {i: text or "" for i, text in extra}
    some = 0
    for row in got:
        base = base_spans(texts[row.doc_id])
        kinds = [kind for *_, kind in base]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert row.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        every = row.spans.split(",") if row.spans else []
        assert set(joined(base).split(",")) - {""} <= set(every)
        begins = [int(span.split(":")[1]) for span in every]
        assert begins == sorted(begins)
        some += bool(base)
    assert some > 8


def plain_probabilities(network: language.Network, stream: bytes) -> np.ndarray:
    """The label probabilities of a stream's bytes, step by step and unit by unit."""
    def states(side, codes):
        w, u = network.weights[f"w{side}"], network.weights[f"u{side}"]
        width = u.shape[0]
        h, out = [0.0] * width, []
        for code in codes:
            g = [sum(h[k] * float(u[k, j]) for k in range(width)) for j in range(3 * width)]
            z, r = ([1 / (1 + math.exp(-(float(w[code, base + j]) + g[base + j]))) for j in range(width)] for base in (0, width))
            c = [math.tanh(float(w[code, 2 * width + j]) + r[j] * g[2 * width + j]) for j in range(width)]
            h = [c[j] + z[j] * (h[j] - c[j]) for j in range(width)]
            out.append(h)
        return out

    forward, backward = states("f", stream), states("b", stream[::-1])[::-1]
    raw = np.array([a + b for a, b in zip(forward, backward, strict=True)]) @ network.weights["out"] + network.weights["bias"]
    raw = np.exp(raw - raw.max(1, keepdims=True))
    return raw / raw.sum(1, keepdims=True)


def test_languages_by_a_plain_forward_pass(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    network = language.trained(*language.sample(docs, "doc_id", "text", "lang"))
    rows = [(r.doc_id, r.text) for r in docs.filter("doc_id % 20 = 0").select("doc_id", "text").collect() if len(r.text or "") < 4000]
    rows += [(9001, "é" * 100), (9002, "x" * 60 + " Straße"), (9003, "12 34"), (9004, None), (9005, "")]
    got = {r.doc_id: r for r in language.identified_by(network, cases.frame(spark, rows)).collect()}
    many = 0
    for i, text in rows:
        stream = " ".join(re.findall("[a-z\x80-\U0010ffff]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))).encode()
        if not stream:
            assert (got[i].lang_pred, got[i].score) == ("und", 0)
            continue
        sums = np.zeros(len(network.labels))
        for at in range(0, len(stream), language.STRIDE):
            before = min(at, language.MARGIN)
            p = plain_probabilities(network, stream[at - before: at + language.STRIDE + language.MARGIN])
            sums += p[before: before + language.STRIDE].sum(0)
        assert got[i].lang_pred == network.labels[int(sums.argmax())]
        assert got[i].score == pytest.approx(sums.max() / len(stream), abs=1e-4)
        if len(stream) > language.STRIDE:
            # a state that has read the whole stream says hardly anything else than one that begins at the margin
            assert plain_probabilities(network, stream).mean(0).max() == pytest.approx(got[i].score, abs=0.01)
            many += 1
    assert many > 2


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_empty_and_awkward_tables(spark, name, stage):
    """No row, no result; extra columns don't disturb; ids that repeat or are missing, NULL and empty texts have a result."""
    docs = cases.frame(spark, cases.awkward_texts()).selectExpr("*", "IF(doc_id % 2 = 0, 'en', 'de') AS lang", "'s' AS source", "0L AS n_chars")
    empty = stage(spark, docs.limit(0), SMALL)
    assert empty.count() == 0
    found = stage(spark, docs, SMALL)
    if name != "packing":
        assert found.columns == empty.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert found.count() > 0


def test_the_pipeline_on_an_empty_table(spark, tmp_path):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    spark.createDataFrame([], schema).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
