"""Counting over a whole corpus without a row per item.

Documents are dealt into blocks by their id. A block sends the distinct items it holds to the segment
that owns their hash, packed into one row per block and segment. A segment sees an item at most once per
block, however often documents repeat it, and answers each block in the block's own order. The
documents' shuffle is the same for every pass of a plan, so Spark runs it once and reads it again.

Blocks hold about block_bytes of text. On very large corpora they grow with the square root of the
input, so that a row between a block and a segment keeps about a kilobyte.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplemart.llm.common import SPACE, mixed, pieces, shipped, shuffle_tasks, text_buffer

BLOCK_BYTES = 4 << 20
LEAST_PIECE = 1 << 10
#: Of one run of the array operations below.
BATCH_BYTES = 1 << 19
MESSAGE = "block int, segment int, payload binary"


def block_count(total_bytes: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, min(pieces(total_bytes, block_bytes), int(math.sqrt(total_bytes / LEAST_PIECE))))


def in_blocks(docs: DataFrame, id_col: str, text_col: str, blocks: int) -> DataFrame:
    """block, doc_id, text (NULL as empty), and the whole row as given. Copies and rows without an id are
    dealt by their text too, and rows that repeat by the partition that they are read in."""
    shipped(docs.sparkSession)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    tasks = max(shuffle_tasks(docs.sparkSession), pieces(blocks, 3))
    return docs.select(
        F.pmod(F.xxhash64(docs[id_col], text, F.spark_partition_id()), F.lit(blocks)).cast("int").alias("block"),
        docs[id_col].cast("long").alias("doc_id"), text.alias("text"),
        F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("row"),
    ).repartition(tasks, "block")


def messages(block: int, pairs: Iterator[tuple[int, bytes]]) -> pa.Table:
    rows = list(pairs)
    return pa.table({
        "block": pa.array([block] * len(rows), pa.int32()),
        "segment": pa.array([s for s, _ in rows], pa.int32()),
        "payload": pa.array([p for _, p in rows], pa.binary())})


def cuts(values: np.ndarray, segments: int, bits: int) -> np.ndarray:
    """Where each segment begins in sorted values of so many bits, and the end."""
    width = min(2**64 - 1, -(-(1 << bits) // segments))
    return np.append(np.searchsorted(values, np.arange(segments, dtype=np.uint64) * np.uint64(width)), len(values))


def sent(blocked: DataFrame, ask: Callable[[pa.Table], Iterator[tuple[int, bytes]]],
         answers: DataFrame | None = None) -> DataFrame:
    """ask gives a block's messages by segment; with answers, it gets those to the block too."""
    if answers is None:
        return blocked.groupBy("block").applyInArrow(
            lambda key, t: messages(key[0].as_py(), ask(t)), MESSAGE)
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda key, t, a: messages(key[0].as_py(), ask(t, by_segment(a))), MESSAGE)


def answered(asked: DataFrame, reply: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """reply gets what the blocks sent to one segment and gives an answer to each."""
    def run(t):
        replies = reply(t["payload"].to_pylist())
        return pa.table({"block": t["block"], "segment": t["segment"], "payload": pa.array(replies, pa.binary())})

    return asked.groupBy("segment").applyInArrow(run, MESSAGE)


def by_segment(answers: pa.Table) -> dict[int, bytes]:
    return dict(zip(answers["segment"].to_pylist(), answers["payload"].to_pylist(), strict=True))


def finished(blocked: DataFrame, answers: DataFrame, finish: Callable[[pa.Table, dict[int, bytes]], pa.Table],
             schema: T.StructType) -> DataFrame:
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda key, t, a: finish(t, by_segment(a)), schema)


def result_schema(docs: DataFrame, text_col: str, results: dict[str, T.DataType]) -> T.StructType:
    """row and the result columns."""
    row = T.StructType([f for f in docs.schema.fields if f.name != text_col])
    return T.StructType([T.StructField("row", row, False), *(T.StructField(n, k) for n, k in results.items())])


def unfolded(found: DataFrame, docs: DataFrame, text_col: str, results: dict[str, T.DataType]) -> DataFrame:
    """The columns of docs without the text, then the results; a result takes the place of a column of its name."""
    kept = [c for c in docs.columns if c != text_col and c not in results]
    return found.select(*[F.col("row")[c].alias(c) for c in kept], *results)


def batches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts, of about BATCH_BYTES each; a longer text is a run of its own."""
    sizes = np.array([0]) if not len(texts) else text_buffer(texts)[1]
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + BATCH_BYTES, "right")) - 1)
        yield begin, end
        begin = end


class Rolling:
    """Hashes of all words of texts by prefix sums of a polynomial modulo 2**64 with random byte values."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**64, 256, np.uint64)
        self.bases = [int(x) | 5 for x in rng.integers(0, 2**64, 2, np.uint64)]
        self.tables = [self._powers(b, 1) for b in self.bases]
        self.inverse = [self._powers(pow(b, -1, 2**64), 1) for b in self.bases]

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base & (2**64 - 1), np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def _reach(self, which: int, n: int) -> None:
        if len(self.tables[which]) < n:
            n = max(n, 1 << 16)
            self.tables[which] = self._powers(self.bases[which], n)
            self.inverse[which] = self._powers(pow(self.bases[which], -1, 2**64), n)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._reach(0, len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.tables[0][: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverse[0][starts] + (ends - starts).astype(np.uint64))

    def runs(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Of every n consecutive words, also across texts."""
        if len(hashes) < n:
            return np.zeros(0, np.uint64)
        self._reach(1, len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.tables[1][: len(hashes)], out=sums[1:])
        return mixed((sums[n:] - sums[:-n]) * self.inverse[1][: len(hashes) - n + 1])


def word_bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts, where words begin and end in them, and how many words each text has."""
    data, offsets = text_buffer(texts)
    # a blank before each text keeps the words of two texts apart
    at = offsets[:-1] + np.arange(len(offsets) - 1)
    padded = np.full(len(data) + len(at) + 1, 0x20, np.uint8)
    keep = np.ones(len(padded), bool)
    keep[at] = False
    keep[-1] = False
    padded[keep] = data
    inside = ~SPACE[padded]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    counts = np.diff(np.append(np.searchsorted(starts, at), len(starts)))
    return padded, starts, ends, counts
