"""Language identification by a bidirectional gated recurrent network over bytes.

A document's stream is its UTF-8 bytes, ASCII letters lower-cased, with one blank for each run of other ASCII
signs. The network reads the stream in both directions and labels every position, blanks too; a document's
probabilities are the mean over all positions. States carry over words: a stream is labelled in windows of STRIDE
positions, and each is read with MARGIN more positions on either side, so memory is bounded whatever a text's
length. The network is trained in numpy by backpropagation through time on passages of a bounded sample, joined in
random order, so the label changes within the sequences it sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplemart.llm.common import mapped, pieces, shipped

UNKNOWN = "und"
#: The sample: rows of all languages together, in turn from each, and passages of each row, evenly over its whole text.
SAMPLE_ROWS = 3000
SAMPLE_PASSAGES = 8
SAMPLE_PARTS = 64
#: Bytes of a passage, at most, and of a sequence in training.
PASSAGE = 32
SEQUENCE = 64
#: Positions labelled together, and read besides on either side.
STRIDE = 256
MARGIN = 32
#: Windows read together.
WINDOWS = 1024
WIDTH = 8
#: Of training, at least.
STEPS = 500

_LETTER = regex.compile(r"\p{L}")
_BLANK = 0x20
_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else _BLANK for b in range(256))


def stream_of(text: str) -> np.ndarray:
    """The bytes that the network reads."""
    codes = np.frombuffer(text.encode().translate(_FOLD), np.uint8)
    blank = codes == _BLANK
    codes = codes[~(blank & np.insert(blank[:-1], 0, True))] if len(codes) else codes
    return codes[:-1] if len(codes) and codes[-1] == _BLANK else codes


def passages_of(stream: np.ndarray, most: int) -> list[bytes]:
    """So many passages of whole words, evenly over the stream, or fewer if they would meet; a longer word is cut."""
    count = min(most, pieces(len(stream), PASSAGE, 0))
    begins = np.insert(np.flatnonzero(stream == _BLANK) + 1, 0, 0)
    found = []
    for i in range(min(count, len(begins))):
        at = begins[i * len(begins) // count]
        passage = stream[at: at + PASSAGE + 1].tobytes()
        found.append(passage[: passage.rindex(b" ")] if len(passage) > PASSAGE and b" " in passage else passage[:PASSAGE])
    return found


@dataclass
class Network:
    """Weights by name, for one direction each: w (byte to gates), u (state to gates); out and bias of the labels.

    Byte 0, which no stream has, stands for no position: it adds nothing, so a state that is zero stays zero."""
    labels: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def new(labels: list[str], width: int, rng: np.random.Generator) -> Network:
        scale = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        weights = {}
        for side in "fb":
            weights |= {f"w{side}": scale(256, 3 * width), f"u{side}": scale(width, 3 * width)}
            weights[f"w{side}"][0] = 0
        weights |= {"out": scale(2 * width, len(labels)), "bias": np.zeros(len(labels), np.float32)}
        return Network(labels, weights)

    def _run(self, side: str, codes: np.ndarray, states: np.ndarray, keep: list | None) -> None:
        """Fills states (steps, width, sequences) with those after each byte of codes (steps, sequences)."""
        w, u = np.ascontiguousarray(self.weights[f"w{side}"].T), np.ascontiguousarray(self.weights[f"u{side}"].T)
        width = u.shape[1]
        h = np.zeros((width, codes.shape[1]), u.dtype)
        for t in (range(len(codes)) if side == "f" else range(len(codes) - 1, -1, -1)):
            x = w.take(codes[t], 1)
            g = u @ h
            gates = x[: 2 * width]
            gates += g[: 2 * width]
            np.negative(gates, gates)
            np.exp(gates, gates)
            gates += 1
            np.reciprocal(gates, gates)
            z, r = gates[:width], gates[width:]
            candidate = np.tanh(x[2 * width:] + r * g[2 * width:])
            if keep is not None:
                keep.append((t, h, z, r, candidate, g[2 * width:]))
            h = candidate + z * (h - candidate)
            states[t] = h

    def _labelled(self, codes: np.ndarray, begin: int, end: int, keep: dict | None = None) -> np.ndarray:
        """Of each label at each step from begin to end: steps, labels, sequences."""
        width = len(self.weights["uf"])
        states = np.empty((len(codes), 2 * width, codes.shape[1]), self.weights["uf"].dtype)
        for i, side in enumerate("fb"):
            self._run(side, codes, states[:, i * width: (i + 1) * width], None if keep is None else keep.setdefault(side, []))
        if keep is not None:
            keep["states"] = states
        p = self.weights["out"].T @ states[begin: end] + self.weights["bias"][:, None]
        p -= p.max(1, keepdims=True)
        np.exp(p, p)
        p /= p.sum(1, keepdims=True)
        return p

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Of each label at each byte of sequences of one length: steps, sequences, labels."""
        return self._labelled(np.ascontiguousarray(codes.T), 0, codes.shape[1]).transpose(0, 2, 1)

    def gradients(self, codes: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all bytes (sequences, steps; so are targets), backwards through time."""
        n, steps = codes.shape
        codes, keep = np.ascontiguousarray(codes.T), {}
        p = self._labelled(codes, 0, steps, keep)
        p[np.arange(steps)[:, None], targets.T, np.arange(n)] -= 1
        p /= n * steps
        width = len(self.weights["uf"])
        grads = {"out": np.tensordot(keep["states"], p, ([0, 2], [0, 2])), "bias": p.sum((0, 2))}
        into = self.weights["out"] @ p
        order = np.argsort(codes.ravel(), kind="stable")
        begins = np.flatnonzero(np.diff(codes.ravel()[order], prepend=-1))
        for i, side in enumerate("fb"):
            u, later = self.weights[f"u{side}"], np.zeros((width, n), p.dtype)
            grads[f"u{side}"], grads[f"w{side}"] = np.zeros_like(u), np.zeros_like(self.weights[f"w{side}"])
            of_bytes = np.empty((steps, n, 3 * width), p.dtype)
            for t, h, z, r, candidate, gn in reversed(keep[side]):
                d = later + into[t, i * width: (i + 1) * width]
                dc = d * (1 - z) * (1 - candidate**2)
                dz = d * (h - candidate) * z * (1 - z)
                dr = dc * gn * r * (1 - r)
                of_bytes[t] = np.concatenate([dz, dr, dc]).T
                dg = np.concatenate([dz, dr, dc * r])
                grads[f"u{side}"] += h @ dg.T
                later = d * z + u @ dg
            grads[f"w{side}"][codes.ravel()[order[begins]]] = np.add.reduceat(of_bytes.reshape(-1, 3 * width)[order], begins)
        return grads

    def pooled(self, streams: list[np.ndarray]) -> np.ndarray:
        """For each stream, the sum of its positions' probabilities."""
        counts = np.array([pieces(len(s), STRIDE, 0) for s in streams], np.int64)
        margin = np.zeros(MARGIN, np.uint8)
        padded = [x for s, k in zip(streams, counts, strict=True) for x in (margin, s, np.zeros(k * STRIDE - len(s), np.uint8), margin)]
        flat = np.concatenate(padded) if padded else margin
        owners = np.repeat(np.arange(len(streams)), counts)
        # the windows of a stream follow each other, and each stream before adds two margins
        begins = np.arange(len(owners)) * STRIDE + owners * 2 * MARGIN
        sums = np.zeros((len(streams), len(self.labels)))
        most = max(1, min(WINDOWS, (1 << 24) // (STRIDE * len(self.labels))))
        for at in range(0, len(owners), most):
            codes = flat[begins[at: at + most] + np.arange(STRIDE + 2 * MARGIN)[:, None]]
            p = self._labelled(codes, MARGIN, MARGIN + STRIDE)
            p *= (codes[MARGIN: MARGIN + STRIDE] != 0)[:, None]
            np.add.at(sums, owners[at: at + most], p.sum(0, dtype=np.float64).T)
        return sums


def sequences(passages: list[bytes], targets: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages joined by blanks in an order, cut into sequences, and the label of each position; what is wanting
    at the end is taken from the begin."""
    joined = [passages[i] + b" " for i in order]
    codes = np.frombuffer(b"".join(joined), np.uint8)
    of = np.repeat(targets[order], [len(x) for x in joined])
    shape = (pieces(len(codes), SEQUENCE), SEQUENCE)
    return np.resize(codes, shape), np.resize(of, shape)


def trained(passages: list[bytes], labels: list[str], width: int = WIDTH, steps: int = STEPS, batch: int = 256,
            rate: float = 0.02, seed: int = 7) -> Network:
    """A network that has seen passages, each with its label, for so many steps and each passage at least twice."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    network = Network.new(names, width, rng)
    target = np.array([names.index(x) for x in labels], np.int64)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    step, rounds = 0, max(2, -(-steps * batch * SEQUENCE // sum(len(x) + 1 for x in passages)))
    # few passages make small batches, and no more steps
    rounds = min(rounds, max(2, steps))
    for r in range(rounds):
        codes, of = sequences(passages, target, rng.permutation(len(passages)))
        for at in range(0, len(codes), batch):
            step += 1
            grads = network.gradients(codes[at: at + batch], of[at: at + batch])
            # a batch of few sequences moves the weights little
            size = rate * 0.02 ** (r / rounds) * min(1.0, (len(codes[at: at + batch]) / batch) ** 0.5)
            for name, grad in grads.items():
                m, v = moments[name]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                network.weights[name] -= size * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: the crc32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = SAMPLE_ROWS,
           passages: int = SAMPLE_PASSAGES) -> tuple[list[bytes], list[str]]:
    """Passages and their labels from a bounded sample: rows are taken in turn from each label, in an order
    given by a hash of their ids; then passages evenly over the whole text of each. Of rows equal in id and label
    one is taken, that of the least passages."""
    shipped(docs.sparkSession)
    known = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[label_col].cast("string").alias("label")).filter(
        "doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out(F.col("doc_id")))
    # no task sees all rows of a frequent label: each of its parts offers a share
    order = Window.partitionBy("label", "part").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(SAMPLE_PARTS))).withColumn(
        "turn", F.row_number().over(order)).filter(F.col("turn") <= pieces(rows, SAMPLE_PARTS))
    # of what a label's parts offer, about `rows` rows, each label gives one in turn
    chosen = chosen.withColumn("turn", F.row_number().over(Window.partitionBy("label").orderBy("turn", "part", "doc_id"))).orderBy(
        "turn", "label").limit(rows).select("doc_id", "label").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [b"\n".join(passages_of(stream_of(text.as_py()), passages)) for text in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["label"], pa.array(found, pa.binary())], ["doc_id", "label", "passages"])

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[label_col].cast("string").alias("label"),
                        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    picked = texts.join(F.broadcast(chosen), ["doc_id", "label"]).mapInArrow(run, "doc_id long, label string, passages binary")
    gathered = picked.groupBy("doc_id", "label").agg(F.min("passages").alias("passages")).orderBy("doc_id", "label").collect()
    pairs = [(passage, row.label) for row in gathered for passage in bytes(row.passages).split(b"\n") if passage]
    return [p for p, _ in pairs], [x for _, x in pairs]


RESULTS = {"lang_pred": T.StringType(), "score": T.DoubleType()}


def identified_by(network: Network | None, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (the probability of lang_pred, the mean over its stream's positions)."""
    def run(texts: list[str | None]) -> list[list]:
        streams = [stream_of(text if text is not None and network is not None and _LETTER.search(text) else "") for text in texts]
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for i, sums in enumerate(network.pooled(streams)) if network is not None else ():
            if len(streams[i]):
                best = int(sums.argmax())
                labels[i], scores[i] = network.labels[best], float(min(1.0, sums[best] / len(streams[i])))
        return [labels, scores]

    return mapped(docs, text_col, RESULTS, run)


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """docs with held_out, lang_pred and score, by a network trained on those rows of docs that have an
    id, a label and are not held out.

    lang_pred is a learned label, or 'und' with score 0 where the text is NULL or has no letter, and
    everywhere if nothing is labelled. Only the text decides, so repeated rows, also of one id, are labelled each;
    of labels with the same probability the smaller is taken. Very long texts are read whole. Columns named held_out,
    lang_pred or score are replaced."""
    passages, labels = sample(docs, id_col, text_col, label_col)
    network = trained(passages, labels) if passages else None
    return identified_by(network, docs, text_col).withColumn("held_out", held_out(F.col(id_col)))
