"""What the training-data operators share: input columns, sizes, numbers of tasks, the shared folder."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: The bytes that part words: blank and 0x09 to 0x0D.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the application, once."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp(prefix="llm-package-"))
        for file in package.rglob("*.py"):
            to = at / "files" / file.relative_to(package.parent)
            to.parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(file, to)
        context.addPyFile(shutil.make_archive(str(at / package.name), "zip", at / "files"))
        _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors can reach: under spark.checkpoint.dir, or where
    that is unset and the master is local, under the machine's own temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder; its lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that operators read, as doc_id (long) and text (string, NULL as empty)."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """The bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(docs[text_col]).cast("long"))).first()[0] or 0


def id_bounds(docs: DataFrame, buckets: int) -> list[int]:
    """Ids that cut the rows of docs (doc_id) into so many buckets of about the same size, or fewer.
    Each is above the least key; rows without an id have the least there is."""
    if buckets < 2:
        return []
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("long"))
    found = docs.agg(
        F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], F.lit(max(10_000, 20 * buckets))).alias("cuts"),
        F.min(key).alias("least")).first()
    return sorted({b for b in found["cuts"] or [] if b > found["least"]})


def words_of(text: Column) -> Column:
    """The words of a text, parted by blanks and 0x09 to 0x0D."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def pieces(total: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(total / each))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(values: np.ndarray) -> bytes:
    """An integer array, byte by byte of all values, compressed."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def packed_sorted(values: np.ndarray) -> bytes:
    """A sorted array of unsigned 64-bit integers, as its steps."""
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without NULLs, and where each text begins, with the end of the last."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def mapped(docs: DataFrame, text_col: str, results: dict[str, T.DataType], run: Callable[[list[str | None]], list]) -> DataFrame:
    """docs with result columns that run makes of the texts (None where NULL), one array each. A result
    takes the place of a column of its name; other columns pass through."""
    shipped(docs.sparkSession)
    kept = [c for c in docs.columns if c not in results]
    fields = [f for f in docs.schema.fields if f.name not in results]
    names = [f"c{i}" for i in range(len(kept))]
    passed = [docs[c].alias(n) for c, n in zip(kept, names, strict=True)]
    # a text that passes through needn't be sent twice
    there = kept.index(text_col) if text_col in kept and isinstance(docs.schema[text_col].dataType, T.StringType) else None
    source = docs.select(*passed, *([docs[text_col].cast("string").alias("text")] if there is None else []))
    at = len(kept) if there is None else there
    kinds = [to_arrow_type(kind) for kind in results.values()]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)]
                          + [T.StructField(f"r{i}", kind) for i, kind in enumerate(results.values())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for begin, end in runs_of(b.column(at)):
                part = b.slice(begin, end - begin)
                found = run(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(names)], *(pa.array(x, k) for x, k in zip(found, kinds, strict=True))],
                    [*names, *(f"r{i}" for i in range(len(kinds)))])

    out = source.mapInArrow(each, schema)
    return out.select(*[out[n].alias(c) for n, c in zip(names, kept, strict=True)],
                      *[out[f"r{i}"].alias(c) for i, c in enumerate(results)])


def runs_of(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most so many bytes together; a longer text is a run of its own."""
    sizes = np.cumsum(np.asarray(pa.compute.binary_length(texts).fill_null(0)), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield begin, end
        begin = end
