"""Near-duplicates by fingerprints of word shingles that differ in few bits.

Two fingerprints of 64 bits that differ in two bits at most, cut into two halves, have a half that
differs by one bit at most. So each distinct fingerprint is indexed 64 times: for either half, with
each of its bits left out in turn. Fingerprints with an equal variant meet, are compared in full, and
a spanning forest of their links goes on to the connected components. Meetings of very many are cut
again by variants of the other half's quarters, then eighths; after that at most 2**8 values per
variant of the rest are left, so every meeting is bounded and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.llm.common import checkpointed, identified, shipped
from peoplemart.llm.components import components
from peoplemart.sources.storage import staged

SHINGLE = 3
DISTANCE = 2
#: Meetings up to this size are compared pair by pair, within one array.
MOST_TOGETHER = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Of the words of a UTF-8 text: bit by bit, whether over half of the shingles' hashes have it."""
    return int(_fingerprints([text], 1, shingle)[0])


def _hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = memoryview(b" ".join(words))
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = [0, *ends[: -shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[b:e], 42) for b, e in zip(begins, (ends[shingle - 1:] - 1).tolist(), strict=True)]


def _fingerprints(texts: Iterable[bytes], n: int, shingle: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, text in enumerate(texts):
        hashes = np.array(_hashes(text, shingle), np.uint64)
        if not len(hashes):
            continue
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 14):  # very long texts bit by bit in parts
            part = hashes[at: at + (1 << 14)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int32)
        out[i] = weights[2 * ones > len(hashes)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed 64-bit integer) of every row.

    A-Z are lower-cased; words are parted by blanks and 0x09 to 0x0D; a shingle is so many words in a
    row, joined by blanks, each time it occurs. A text of fewer words is one shingle; a text without
    words, or NULL, has fingerprint zero."""
    shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _fingerprints((t.as_py().encode() for t in b["text"]), len(b), shingle)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return identified(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _forest(group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links among a few fingerprints connect: each to the first it reaches."""
    n = len(group)
    if n == 2:
        linked = np.bitwise_count(group[0] ^ group[1]) <= distance
        return (group[1:], group[:1]) if linked else (group[:0], group[:0])
    near = np.bitwise_count(group[:, None] ^ group[None, :]) <= distance
    root = np.arange(n)
    while True:
        least = np.where(near, root[None, :], n).min(1)
        least = np.minimum(least, least[least])
        if (least == root).all():
            break
        root = least
    other = np.flatnonzero(root != np.arange(n))
    return group[other], group[root[other]]


def _linked(met: DataFrame, distance: int) -> DataFrame:
    """met: key and fp, sorted by key within each task. Links a, b within each key."""
    shipped(met.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
            begins = np.insert(ends[:-1], 0, 0)
            values, found = fp.view(np.uint64), [(np.zeros(0, np.uint64),) * 2]
            pairs = begins[ends - begins == 2]
            a, b = values[pairs], values[pairs + 1]
            near = np.bitwise_count(a ^ b) <= distance
            found.append((a[near], b[near]))
            found += [_forest(values[i:j], distance) for i, j in zip(begins, ends, strict=True) if j - i > 2]
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
            once = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(once[0]), pa.array(once[1])], ["a", "b"])

        for batch in batches:
            key = np.concatenate([key, batch["key"].to_numpy()])
            fp = np.concatenate([fp, batch["fp"].to_numpy()])
            last = int(np.searchsorted(key != key[-1], False)) if len(key) and key[0] == key[-1] else (
                int(np.flatnonzero(key != key[-1])[-1]) + 1 if len(key) else 0)
            if last:  # the last key may go on in the next batch
                yield links(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
        if len(key):
            yield links(key, fp)

    return met.mapInArrow(run, "a long, b long").distinct()


def _halves(fps: DataFrame) -> DataFrame:
    """fp, half (where the half used begins) and key: the half with one of its bits left out, and which."""
    options = F.array(*[
        F.struct(F.lit(s).alias("half"), F.lit(i).alias("bit")) for s in (0, 32) for i in range(32)])
    each = fps.select("fp", F.explode(options).alias("o"))
    value = F.expr("shiftrightunsigned(fp, o.half) & 4294967295L & ~shiftleft(1L, o.bit)")
    return each.select("fp", "o.half", value.bitwiseOR(F.expr("shiftleft(CAST(o.half + o.bit AS BIGINT), 32)")).alias("key"))


def _sized(rows: DataFrame) -> DataFrame:
    return rows.withColumn("size", F.count("*").over(Window.partitionBy("key"))).filter("size > 1")


def links(fps: DataFrame, distance: int = DISTANCE, most: int = MOST_TOGETHER) -> DataFrame:
    """fps: distinct fp (long). Links a, b between fingerprints of two or fewer differing bits, enough
    of them to connect all that such links connect."""
    if not 0 <= distance <= 2:
        raise ValueError("halves with one bit left out find up to two differing bits")
    met = _sized(_halves(fps))
    found = _linked(met.filter(F.col("size") <= most).select("key", "fp"), distance)
    # a meeting's fingerprints agree in a half but for one bit: the other half differs in two bits at most
    for bits in (16, 8):
        many = met.filter(F.col("size") > most).select("fp", "half", "key")
        other = F.when(F.col("half") == 0, 32).otherwise(0) if bits == 16 else F.col("half")
        met = _sized(_parts(many, bits, other))
        small = met.filter(F.col("size") <= most) if bits == 16 else met
        found = found.unionByName(_linked(small.select("key", "fp"), distance))
    return found


def _parts(rows: DataFrame, bits: int, base: Column) -> DataFrame:
    """Cuts what is left of a half (at base, 2 * bits wide) in two and leaves each bit of a part out in
    turn. half becomes where the part not used begins."""
    options = F.array(*[
        F.struct(F.lit(p).alias("used"), F.lit(i).alias("bit")) for p in (0, 1) for i in range(bits)])
    each = rows.select("fp", "key", base.alias("base"), F.explode(options).alias("o"))
    shift = F.col("base") + F.col("o.used") * bits
    mask = F.lit((1 << bits) - 1).cast("long") - F.expr("shiftleft(1L, o.bit)")
    value = F.expr(f"shiftrightunsigned(fp, CAST(base + o.used * {bits} AS INT))").bitwiseAND(mask)
    return each.select(
        "fp", (F.col("base") + (1 - F.col("o.used")) * bits).cast("int").alias("half"),
        F.xxhash64("key", value, shift, "o.bit").alias("key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp and component_id of every row: the smallest id among the rows that links reach.

    Rows of equal fingerprints are linked, so copies need no search of their own. Rows without an id
    are linked like others and get the smallest id of their component, NULL if it has none. Empty
    and NULL texts have fingerprint zero. No row, no result."""
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    least = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(least.select("fp"), distance))
    of = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(of.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """docs with one row of each group of near-duplicates: of the smallest id (rows without one come last), of several
    such rows any one. All columns pass through, whatever their names."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    # rows are numbered once, in what is written, so that rows of one id are told apart
    numbered = staged(docs.toDF(*plain).withColumn("row", F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(numbered, "row", plain[docs.columns.index(text_col)], shingle, distance)
    ids = numbered.select("row", F.col(plain[docs.columns.index(id_col)]).cast("long").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "row")
    stays = groups.join(ids, groups["doc_id"] == ids["row"]).groupBy("component_id").agg(F.min(order).alias("first")).select(
        F.col("first.row").alias("row"))
    return numbered.join(stays, "row", "left_semi").select(*plain).toDF(*docs.columns)
