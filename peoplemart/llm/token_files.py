"""Token ids as files: ranks by frequency, in bytes of a variable number, with the numbers of bytes apart.

A first pass counts every token of the corpus, so that frequent ids get small ranks. A file holds its
documents' ids, their lengths, control bytes (two bits for each of four ranks: bytes less one) and the
ranks' bytes. It is read by looking up control bytes in a table. Files are rows of a Parquet table,
since only Spark's writers reach every kind of shared store.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplemart.llm.common import (
    SPACE, id_bounds, identified, packed, pieces, runs_of, shared_folder, shipped, shuffle_tasks, text_buffer, text_bytes, unpacked)
from peoplemart.sources.storage import removed

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
PART_BYTES = 16 << 20
FILE_BYTES = 1 << 20
#: Texts that are encoded together.
RUN_BYTES = 4 << 20
MOST_PARTS = 4096
#: Pieces that are encoded as one text, with a special token between them.
JOINED = 512
#: Pieces of text whose ids a Python worker keeps, at most.
REMEMBERED = 400_000
MAGIC = b"FRVB"
_HEAD = struct.Struct("<4sIQQQQ")

# A text may be cut beside blanks, and between an ASCII letter and any other ASCII sign but an
# apostrophe: no piece that the tokenizer splits off holds both.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_KIND = np.where(SPACE, 0, 2).astype(np.uint8)
_KIND[0x61:0x7B] = 1
_KIND[0x80:] = 3
_KIND[ord("'")] = 3
_CUTS = np.zeros(16, bool)
_CUTS[[0b0001, 0b0010, 0b0011, 0b0100, 0b1000, 0b1100, 0b0110, 0b1001]] = True


@dataclass
class Tokens:
    """Ids of texts with end_id after each, and how many each text has."""
    ids: np.ndarray
    lengths: np.ndarray


class Encoder:
    """Encodes with a tokenizer that folds the case of ASCII and splits texts at blanks and around runs
    of letters. Equal pieces are encoded once; what is kept is bounded."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end_id
        # a special token parts a text before anything else is done to it, and pieces hold no name of one
        self.between = next((
            (i, t.content) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items())
            if t.special and "<|" in t.content and not (t.normalized or t.lstrip or t.rstrip or t.single_word)), None)
        self.known: dict[bytes, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _joined_pieces(self, words: list[str]) -> list[bytes]:
        """The ids of each piece; a text of its own for each costs half as much again."""
        if not self.between:
            return self._plain(words)
        end, name = self.between
        out = []
        for ids in self._plain([name.join(words[at: at + JOINED]) for at in range(0, len(words), JOINED)]):
            cuts = (4 * np.flatnonzero(np.frombuffer(ids, np.uint32) == end)).tolist()
            out += [ids[a:b] for a, b in zip([0, *(x + 4 for x in cuts)], [*cuts, len(ids)], strict=True)]
        return out

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct pieces, which of them the texts are made of, and how many each text has."""
        data, offsets = text_buffer(texts)
        data = _LOWER[data]
        kind = _KIND[data]
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = _CUTS[kind[:-1] * 4 + kind[1:]]
        cut[offsets] = True
        inside = kind > 0
        begins = np.flatnonzero(cut[:-1] & inside)
        filled = np.insert(np.cumsum(inside, dtype=np.int32), 0, 0)
        at = np.append(filled[begins], filled[-1]).astype(np.int32)
        flat = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(at), pa.py_buffer(data[inside])])
        coded = flat.dictionary_encode()
        counts = np.diff(np.append(np.searchsorted(begins, offsets[:-1]), len(begins)))
        return coded.dictionary, np.asarray(coded.indices), counts

    def of_pieces(self, found: pa.Array) -> list[bytes]:
        words = found.to_pylist()
        ids = list(map(self.known.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        for at in range(0, len(new), 10_000):
            part = new[at: at + 10_000]
            for i, x in zip(part, self._joined_pieces([words[i].decode() for i in part]), strict=True):
                ids[i] = x
                if len(self.known) < REMEMBERED:
                    self.known[words[i]] = x
        return ids

    def encode(self, texts: pa.Array) -> Tokens:
        whole = [i for i, t in enumerate(texts.to_pylist()) if "<|" in t]  # may hold a special token's name
        if whole:
            return self._joined(texts, whole)
        found, which, counts = self.pieces(texts)
        ids = self.of_pieces(found)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        start = np.cumsum(size) - size
        # an end id after the pieces of each text
        ends = np.cumsum(counts) + np.arange(len(counts))
        order = np.full(len(which) + len(counts), len(ids), np.int64)
        inner = np.ones(len(order), bool)
        inner[ends] = False
        order[inner] = which
        flat, size, start = np.append(flat, np.uint32(self.end)), np.append(size, 1), np.append(start, len(flat))
        n = size[order]
        total = np.cumsum(n)
        out = flat[np.repeat(start[order] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        return Tokens(out, np.diff(np.insert(total[ends], 0, 0)) if len(ends) else np.zeros(0, np.int64))

    def _joined(self, texts: pa.Array, whole: list[int]) -> Tokens:
        parts, at = [], 0
        for i in [*whole, len(texts)]:
            if i > at:
                parts.append(self.encode(texts.slice(at, i - at)))
            if i < len(texts):
                ids = np.append(np.frombuffer(self._plain([texts[i].as_py()])[0], np.uint32), np.uint32(self.end))
                parts.append(Tokens(ids, np.array([len(ids)])))
            at = i + 1
        return Tokens(np.concatenate([p.ids for p in parts]), np.concatenate([p.lengths for p in parts]))


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One for each Python worker."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def packed_ranks(ranks: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of the ranks (uint32) of documents, and how many each document has.
    A document's controls begin with a byte of their own."""
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    controls = -(-lengths // 4)
    fours = np.zeros(4 * int(controls.sum()), np.uint8)
    fours[_slots(lengths, controls)] = more
    fours = fours.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    used = np.arange(4)[None, :] <= more[:, None]
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[used]
    ends = np.insert(np.cumsum(more.astype(np.int64) + 1), 0, 0)
    at = np.insert(np.cumsum(lengths), 0, 0)
    return control.astype(np.uint8).tobytes(), data.tobytes(), controls, np.diff(ends[at])


def _slots(lengths: np.ndarray, controls: np.ndarray) -> np.ndarray:
    """Which of the control bytes' quarters hold a rank: at a document's end some may not."""
    spare = np.cumsum(4 * controls - lengths) - (4 * controls - lengths)
    return np.arange(int(lengths.sum())) + np.repeat(spare, lengths)


#: The numbers of bytes of four ranks, by control byte.
_SIZES = (1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)).astype(np.uint8)
_KEEP = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpacked_ranks(control: bytes, data: bytes, lengths: np.ndarray) -> np.ndarray:
    if not lengths.sum():
        return np.zeros(0, np.uint32)
    size = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[_slots(lengths, -(-lengths // 4))].astype(np.int64)
    start = np.cumsum(size) - size
    padded = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    words = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16 | padded[3:] << 24
    return words[start] & _KEEP[size - 1]


def file_content(doc_ids: list[int | None], lengths: np.ndarray, control: bytes, data: bytes) -> bytes:
    ids = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    missing = np.packbits([x is None for x in doc_ids]).tobytes()
    head = _HEAD.pack(MAGIC, 1, len(doc_ids), int(lengths.sum()), len(control), len(data))
    return b"".join([head, ids, missing, lengths.astype("<u8").tobytes(), control, data])


def from_file(content: bytes, id_of: np.ndarray) -> tuple[list[int | None], Tokens]:
    magic, version, docs, _, n_control, n_data = _HEAD.unpack_from(content)
    if magic != MAGIC or version != 1:
        raise ValueError("not a token file")
    at = _HEAD.size
    ids = np.frombuffer(content, "<i8", docs, at)
    missing = np.unpackbits(np.frombuffer(content, np.uint8, -(-docs // 8), at + 8 * docs), count=docs)
    at += 8 * docs - (-docs // 8)
    lengths = np.frombuffer(content, "<u8", docs, at).astype(np.int64)
    at += 8 * docs
    ranks = unpacked_ranks(content[at: at + n_control], content[at + n_control: at + n_control + n_data], lengths)
    return [None if m else int(i) for i, m in zip(ids, missing, strict=True)], Tokens(id_of[ranks], lengths)


_RAW = "doc_ids array<long>, lengths array<long>, ids binary"


def _one(values: list[tuple[str, object, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for _, v, kind in values], [n for n, *_ in values])


def _encoded(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """The ids of runs of documents, in no order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, end_id)
        for b in batches:
            for begin, end in runs_of(b["text"], RUN_BYTES):
                part = b.slice(begin, end - begin)
                tokens = own.encode(part["text"])
                yield _one([("doc_ids", part["doc_id"].to_pylist(), pa.list_(pa.int64())),
                            ("lengths", tokens.lengths, pa.list_(pa.int64())), ("ids", packed(tokens.ids), pa.binary())])

    return identified(docs, id_col, text_col).mapInArrow(run, _RAW)


def ids_by_frequency(raw: DataFrame, vocabulary: int) -> np.ndarray:
    """Every id of the vocabulary (a bounded number), the most frequent first, then the smaller."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for ids in b["ids"]:
                total += np.bincount(unpacked(ids.as_py(), np.uint32), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    for row in raw.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    return np.lexsort((np.arange(vocabulary), -counts)).astype(np.uint32)


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
          end_id: int = END_ID) -> None:
    """Writes files (part, number, before, n_ids, content) to folder/files and the ids by rank to
    folder/ranks. Documents go by ascending id, those without one first, rows of one id by their ids.
    before counts the ids of the part's files before. NULL texts have no token but the end."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    shipped(spark)
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    vocabulary = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1)
    # texts are encoded once; the ranks are known when all are
    _encoded(docs, id_col, text_col, path, end_id).write.option("compression", "none").parquet(f"{folder}/raw")
    raw = spark.read.schema(_RAW).parquet(f"{folder}/raw")
    id_of = ids_by_frequency(raw, vocabulary)
    rank_of = np.empty(vocabulary, np.uint32)
    rank_of[id_of] = np.arange(vocabulary, dtype=np.uint32)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_ids, lengths, ids in zip(b["doc_ids"], b["lengths"], b["ids"], strict=True):
                lengths = np.array(lengths.as_py(), np.int64)
                control, data, *sizes = packed_ranks(rank_of[unpacked(ids.as_py(), np.uint32)], lengths)
                cut = [pa.Array.from_buffers(pa.binary(), len(lengths), [
                    None, pa.py_buffer(np.insert(np.cumsum(n), 0, 0).astype(np.int32)), pa.py_buffer(x)])
                    for x, n in zip((control, data), sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids.as_py(), pa.int64()), pa.array(lengths), *cut],
                                                 ["doc_id", "n_ids", "control", "data"])

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, held, size = None, 0, 0, [], 0

        def file() -> pa.RecordBatch:
            lengths = np.array([n for _, n, *_ in held], np.int64)
            content = file_content([i for i, *_ in held], lengths, b"".join(x[2] for x in held), b"".join(x[3] for x in held))
            return _one([("part", part, pa.int32()), ("number", number, pa.int32()), ("before", before, pa.int64()),
                         ("n_ids", int(lengths.sum()), pa.int64()), ("content", content, pa.binary())])

        for b in batches:
            for own, *row in zip(*(b[c].to_pylist() for c in ("part", "doc_id", "n_ids", "control", "data")), strict=True):
                if held and (own != part or size > FILE_BYTES):
                    yield file()
                    number, before = (number + 1, before + sum(x[1] for x in held)) if own == part else (0, 0)
                    held, size = [], 0
                part = own
                held.append(row)
                size += len(row[2]) + len(row[3])
        if held:
            yield file()

    parts = min(MOST_PARTS, max(shuffle_tasks(spark), pieces(text_bytes(docs, text_col), PART_BYTES)))
    bounds = id_bounds(docs.select(docs[id_col].cast("long").alias("doc_id")), parts)
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("long"))
    at = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b <= key)) if bounds else F.lit(0)
    rows = raw.mapInArrow(ranked, "doc_id long, n_ids long, control binary, data binary").withColumn("part", at.cast("int"))
    rows.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "n_ids", "data").mapInArrow(
        filed, "part int, number int, before long, n_ids long, content binary").write.parquet(f"{folder}/files")
    spark.createDataFrame([(id_of.tobytes(),)], "ids binary").write.parquet(f"{folder}/ranks")
    removed(spark, f"{folder}/raw")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before), n_tokens, and ids_crc32 of the
    document's ids as little-endian unsigned 32-bit integers."""
    shipped(spark)
    id_of = np.frombuffer(spark.read.parquet(f"{folder}/ranks").first()["ids"], np.uint32)
    files = spark.read.parquet(f"{folder}/files")
    # a row for each part, MOST_PARTS at most
    totals = {r.part: r.n for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    starts, so_far = {}, 0
    for part in sorted(totals):
        starts[part] = so_far
        so_far += totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, before, content in zip(b["part"].to_pylist(), b["before"].to_pylist(), b["content"], strict=True):
                doc_ids, tokens = from_file(content.as_py(), id_of)
                ends = np.cumsum(tokens.lengths)
                begins = ends - tokens.lengths
                data = memoryview(tokens.ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * x: 4 * y]) for x, y in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(begins + (starts[part] + before)), pa.array(tokens.lengths),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "before", "content").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs to a new folder that the cluster shares, and reads them back."""
    folder = shared_folder(docs.sparkSession, "tokens")
    write(docs, folder, id_col, text_col)
    return read(docs.sparkSession, folder)
