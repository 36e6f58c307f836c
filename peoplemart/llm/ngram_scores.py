"""Stupid-backoff scores of documents by the n-gram counts of all other documents.

Texts are exploded to n-grams, folded to one for each distinct n-gram of a block of documents with its count
there. A block's n-grams are dealt to the tasks of the count table by ranges of their hash, one list a range,
since a row each would cost more shuffle than its hash. There the lists are rows: grouped by n-gram they are
the count table, which is joined back to the blocks' rows without another shuffle, and the totals return to
the blocks as lists in the same order. There they meet the n-grams of the texts again, a text's own occurrences
are taken off, so it isn't its own evidence, and the logarithms are summed per text. However frequent, an
n-gram is counted once per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplemart.llm import exchange
from peoplemart.llm.common import mixed, pieces, shuffle_tasks, text_bytes

ORDER = 2
BACKOFF = 0.4
#: Of text in a block, and in the texts whose n-grams one task of the count table adds up.
BLOCK_BYTES = 8 << 20
COUNTED_BYTES = 8 << 20
#: The n-gram of no words, the context of single words; a text has it as often as it has words.
EMPTY = 0
_ROLLING = exchange.Rolling(9)
#: A range that may be NULL would be filtered on one side of the join only, and the shuffle not be shared.
_LISTS = T.StructType([
    T.StructField("block", T.IntegerType()), T.StructField("range", T.IntegerType(), False),
    T.StructField("low", T.ArrayType(T.IntegerType()), False), T.StructField("middle", T.ArrayType(T.ShortType()), False),
    T.StructField("top", T.ArrayType(T.ShortType()), False), T.StructField("counts", T.ArrayType(T.LongType()), False)])
RESULTS = {"n_words": T.LongType(), "score": T.DoubleType()}


def _runs(texts: pa.Array, order: int):
    """Of runs of texts: the hashes of the n-grams of each length that begin at each word (EMPTY where
    the text ends before), the row of each word, and the first row and words of each row."""
    for begin, end in exchange.batches(texts):
        data, starts, ends, n = exchange.word_bounds(texts.slice(begin, end - begin))
        row = np.repeat(np.arange(begin, end), n)
        words = _ROLLING.words(data, starts, ends)
        grams = []
        for k in range(1, order + 1):
            hashes = np.full(len(words), EMPTY, np.uint64)
            if len(words) >= k:
                whole = row[k - 1:] == row[: len(row) - k + 1]
                hashes[: len(whole)][whole] = np.maximum(_ROLLING.runs(words, k)[whole], np.uint64(EMPTY + 1))
            grams.append(hashes)
        yield grams, row, begin, n


def _folded(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of the texts in ascending order, and their counts."""
    keys, counts = [np.array([EMPTY], np.uint64)], [np.zeros(1, np.int64)]
    for grams, row, _, _ in _runs(texts, order):
        found = np.unique(np.concatenate([g[g != EMPTY] for g in grams]), return_counts=True)
        keys += [found[0]]
        counts += [found[1]]
        counts[0] += len(row)
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return every, total


def n_grams(blocked: DataFrame, order: int, ranges: int = 1) -> DataFrame:
    """block, range, place, gram (hash), n: the distinct n-grams of each block, of up to order words, and their
    counts there; dealt to as many tasks by the range of the hash, in which place is its own among the block's."""
    def each(key: tuple, t: pa.Table) -> pa.Table:
        every, counts = _folded(t["text"].combine_chunks(), order)
        at = exchange.cuts(every, ranges, 64)
        some = np.flatnonzero(np.diff(at))  # the ranges that have any
        ends = pa.array(np.append(at[some], len(every)), pa.int32())
        # in ascending order, the top 16 bits repeat and cost next to nothing once compressed
        parts = {"low": every.astype(np.uint32).view(np.int32), "middle": (every >> np.uint64(32)).astype(np.uint16).view(np.int16),
                 "top": (every >> np.uint64(48)).astype(np.uint16).view(np.int16), "counts": counts}
        return pa.table({"block": pa.array(np.full(len(some), key[0].as_py(), np.int32)), "range": pa.array(some, pa.int32()),
                         **{name: pa.ListArray.from_arrays(ends, values) for name, values in parts.items()}})

    lists = blocked.groupBy("block").applyInArrow(each, _LISTS).repartitionById(ranges, "range")
    rows = lists.select("block", "range", "middle", "top", "counts", F.posexplode("low").alias("place", "low"))
    low = F.col("low").cast("long").bitwiseAND(0xFFFFFFFF)
    middle = F.col("middle")[F.col("place")].cast("long").bitwiseAND(0xFFFF)
    top = F.col("top")[F.col("place")].cast("long")
    return rows.select(
        "block", "range", "place", F.shiftleft(top, 48).bitwiseOR(F.shiftleft(middle, 32)).bitwiseOR(low).alias("gram"),
        F.col("counts")[F.col("place")].alias("n"))


def answered(grams: DataFrame, tasks: int | None = None) -> DataFrame:
    """block, range, place, gram, others: how often other blocks have an n-gram of a block. The rows are dealt
    to so many tasks by n-gram; by default they stay in their ranges' tasks, as n_grams deals them."""
    keys, dealt = (["range", "gram"], grams) if tasks is None else (["gram"], grams.repartition(tasks, "gram"))
    # counting the blocks keeps the columns of both uses the same, so Spark shuffles the rows once
    counts = dealt.groupBy(*[F.col(k).alias(f"counted_{k}") for k in keys]).agg(
        F.sum("n").alias("total"), F.count("block").alias("blocks")).filter("blocks > 1")
    same = [F.col(k) == F.col(f"counted_{k}") for k in keys]
    return dealt.join(counts.hint("shuffle_hash"), same, "left").select(
        "block", "range", "place", "gram", F.coalesce(F.col("total") - F.col("n"), F.lit(0)).alias("others"))


def _listed(totals: DataFrame) -> DataFrame:
    """block, range, others: the totals of each list of n-grams, in its order."""
    found = totals.groupBy("range", "block").agg(F.sort_array(F.collect_list(F.struct("place", "others"))).alias("list"))
    return found.select("block", "range", F.col("list.others").alias("others"))


def _scores(texts: pa.Array, every: np.ndarray, total: np.ndarray, order: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """The words of each text and the sum of their scores' logarithms, by the totals of all n-grams."""
    n_words, sums = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for grams, row, begin, n in _runs(texts, order):
        others = []  # of each length, how often the n-gram at each word occurs in other texts
        for hashes in grams:
            count, ok = np.zeros(len(hashes), np.int64), hashes != EMPTY
            _, which, own = np.unique(mixed(hashes[ok] + mixed(row[ok].astype(np.uint64))), return_inverse=True, return_counts=True)
            count[ok] = total[np.searchsorted(every, hashes[ok])] - own[which]
            others.append(count)
        rest = np.maximum(1, total[0] - n[row - begin])
        value = np.maximum(1, others[0]) / rest
        for k in range(1, order):
            longer, context = others[k][: len(row) - k], others[k - 1][: len(row) - k]
            fits = np.zeros(len(row), bool)
            fits[k:] = row[k:] == row[: len(row) - k]  # the word has a context of k words
            seen = np.zeros(len(row), bool)
            seen[k:] = fits[k:] & (longer > 0)
            value = np.where(fits, backoff * value, value)
            value[k:][seen[k:]] = (longer / np.maximum(1, context))[seen[k:]]
        n_words[begin: begin + len(n)] = n
        sums[begin: begin + len(n)] = np.bincount(row - begin, np.log(value), len(n))
    return n_words, sums


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
           backoff: float = BACKOFF) -> DataFrame:
    """The rows of docs without the text, with n_words and score: the mean natural logarithm of the
    words' stupid-backoff scores, NULL for a text without words (NULL, empty).

    Words are parted by blanks and 0x09 to 0x0D. A word's score is the count of the longest n-gram (of
    its text, ending there, up to order words) that other rows have, over the count of its first words,
    times backoff for each shortening. A single word counts as seen once at least; its score is over
    the words of all other rows. Every row is a document of its own, whatever its id. A result takes the
    place of a column of its name; other columns pass through. An empty table gives an empty one."""
    size = text_bytes(docs, text_col)
    tasks = max(shuffle_tasks(docs.sparkSession), pieces(size, COUNTED_BYTES))
    blocked = exchange.in_blocks(docs, id_col, text_col, pieces(size, BLOCK_BYTES))
    totals = _listed(answered(n_grams(blocked, order, tasks)))

    def finish(_: tuple, t: pa.Table, a: pa.Table) -> pa.Table:
        texts = t["text"].combine_chunks()
        every, total = _folded(texts, order)
        total += a.sort_by("range")["others"].combine_chunks().flatten().to_numpy()
        n_words, sums = _scores(texts, every, total, order, backoff)
        score = pa.array(sums / np.maximum(1, n_words), mask=n_words == 0)
        return pa.table({"row": t["row"], "n_words": n_words, "score": score})

    found = blocked.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        finish, exchange.result_schema(docs, text_col, RESULTS))
    return exchange.unfolded(found, docs, text_col, RESULTS)
