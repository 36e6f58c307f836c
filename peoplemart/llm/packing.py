"""Batches of like length: bucket boundaries by dynamic programming over all lengths.

Texts longer than a sequence are cut into pieces. The number of pieces of each length is counted over
the whole corpus; the boundaries that pad least are found exactly from these counts (at most as many
as a sequence has words). Inside a bucket, batches take as many pieces as fit a budget of padded words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEQUENCE = 2048
BUCKETS = 16
BUDGET = 32_768
#: Rows that are numbered together, about.
GROUP_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Words, parted by blanks and 0x09 to 0x0D; none in NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The largest length of each bucket, at most so many, so that the padding up to it is least.

    lengths ascend and have a count each. Fewer lengths than buckets: each its own. Of equally good
    choices, the one whose last buckets begin at the smallest lengths."""
    size, held = np.array(lengths, np.float64), np.insert(np.cumsum(np.array(counts, np.float64)), 0, 0)
    n = len(lengths)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    choices = []
    for _ in range(min(buckets, n)):
        cost = best[:-1, None] + size[None, :] * (held[1:][None, :] - held[:-1, None])
        cost[np.tril_indices(n, -1)] = np.inf  # a bucket begins at or before its end
        choices.append(cost.argmin(0))
        best = np.insert(cost.min(0), 0, np.inf)
    found, end = [], n
    for choice in reversed(choices):
        found.append(lengths[end - 1])
        end = int(choice[end - 1])
    return found[::-1]


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
           buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """A row for each piece of each text: doc_id, piece (from 0), begin (its first word, from 0),
    n_words, bucket (the length it is padded to), part and batch (numbers of the bucket's batches).

    Texts without words (NULL, empty) have no piece. A batch holds at most budget padded words, or one
    piece. Pieces are numbered in an order given by a hash, in parts of about GROUP_ROWS, so only a
    part's last batch can be short. Rows of one id stand alone; those without an id are packed too."""
    pieces = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("content"),
                         word_count(docs[text_col].cast("string")).alias("words")).filter("words > 0")
    pieces = pieces.select(
        "doc_id", "content", "words", F.explode(F.sequence(F.lit(0), F.expr(f"CAST((words - 1) DIV {sequence} AS INT)"))).alias("piece"))
    pieces = pieces.select(
        "doc_id", "content", "piece", (F.col("piece").cast("long") * sequence).alias("begin"),
        F.least(F.lit(sequence), F.col("words") - F.col("piece") * sequence).cast("int").alias("n_words"))
    histogram = sorted((r.n_words, r["count"]) for r in pieces.groupBy("n_words").count().collect())  # at most sequence rows
    ends = boundaries([x for x, _ in histogram], [n for _, n in histogram], buckets) or [sequence]
    rows = [sum(n for x, n in histogram if low < x <= high) for low, high in zip([0, *ends[:-1]], ends, strict=True)]
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("k"))
    placed = pieces.withColumn("k", F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e < F.col("n_words"))) + 1)
    placed = placed.withColumn("bucket", at(ends)).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "content", "piece"), at([max(1, round(n / GROUP_ROWS)) for n in rows])).cast("int"))
    order = Window.partitionBy("bucket", "part").orderBy(F.xxhash64("doc_id", "piece", "content"), "doc_id", "piece", "content")
    per_batch = at([max(1, budget // e) for e in ends])
    return placed.withColumn("batch", F.floor((F.row_number().over(order) - 1) / per_batch)).select(
        "doc_id", "piece", "begin", "n_words", "bucket", "part", "batch")
