"""Fingerprints of documents as multisets of paragraphs, by DataFrame functions alone.

Each paragraph is hashed to a wide vector; a fingerprint is the vectors' sum, lane by lane modulo a power of
two. So it doesn't depend on the paragraphs' order, and paragraphs are put in or taken out by adding or
subtracting theirs. Eight lanes of 62 bits tell texts apart, also where a paragraph repeats very often. 128 lanes count
the paragraphs that have a bit: as plus or minus one, the sums' cosine estimates the likeness of two multisets. These
lanes hold any number of paragraphs that a text can have; two share a 64-bit word, with room between them for the carry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.llm.common import id_bounds, pieces, shuffle_tasks, text_bytes

_HASH = (1 << 62) - 1
LANE_BITS = 30
_ROOM = 32
_LANES = sum(((1 << LANE_BITS) - 1) << (_ROOM * i) for i in range(2))
_ONES = sum(1 << (_ROOM * i) for i in range(2))
HASH_WORDS = 8
SIGN_HASHES = 2
#: Words of a fingerprint: hash lanes, sign lanes (two a word), and the number of paragraphs.
WORDS = HASH_WORDS + SIGN_HASHES * _ROOM + 1
BUCKET_BYTES = 8 << 20
MOST_BUCKETS = 4096


def _hashes(text: Column) -> Column:
    """Two independent 64-bit hashes of each paragraph; paragraphs are parted by line feeds."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.struct(
        F.xxhash64(p).alias("a"), F.xxhash64(F.lit("second"), p).alias("b")))


def _sum(hashes: Column, lanes: Callable[[Column], Column], mask: int) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"),
                       lambda total, h: (total + lanes(h)).bitwiseAND(F.lit(mask)))


def _signs(hashes: Column, number: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h["b"], F.lit(number), h["a"]))


def _words(hashes: Column) -> Column:
    found = [_sum(hashes, lambda h, j=j: F.xxhash64(h["a"], F.lit(j), h["b"]).bitwiseAND(F.lit(_HASH)), _HASH)
             for j in range(HASH_WORDS)]
    found += [_sum(_signs(hashes, s), lambda g, k=k: F.shiftrightunsigned(g, k).bitwiseAND(F.lit(_ONES)), _LANES)
              for s in range(SIGN_HASHES) for k in range(_ROOM)]
    return F.array(*found, F.size(hashes).cast("long"))


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """df with the words of a text's fingerprint (array of long)."""
    return df.withColumn("_hashes", _hashes(F.col(text_col))).withColumn(name, _words(F.col("_hashes"))).drop("_hashes")


def _by_word(one: Column, other: Column, hashes: Callable[[Column, Column], Column], signs: Callable[[Column, Column], Column],
             number: Callable[[Column, Column], Column]) -> Column:
    return F.transform(F.arrays_zip(one.alias("x"), other.alias("y")), lambda p, i: F.when(i < HASH_WORDS, hashes(p["x"], p["y"])).when(
        i < WORDS - 1, signs(p["x"], p["y"])).otherwise(number(p["x"], p["y"])))


def added(one: Column, other: Column) -> Column:
    """The fingerprint of both multisets together."""
    return _by_word(one, other, lambda x, y: (x + y).bitwiseAND(F.lit(_HASH)), lambda x, y: (x + y).bitwiseAND(F.lit(_LANES)),
                    lambda x, y: x + y)


def removed(one: Column, other: Column) -> Column:
    """The fingerprint of one without the paragraphs of other, which it must hold."""
    guard = F.lit(_ONES << LANE_BITS)
    return _by_word(one, other, lambda x, y: (x - y).bitwiseAND(F.lit(_HASH)),
                    lambda x, y: (x.bitwiseOR(guard) - y).bitwiseAND(F.lit(_LANES)), lambda x, y: x - y)


def as_text(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: the cosine of the sign lanes' sums, where it is above 0; 1 for equal fingerprints."""
    def sums(words: Column) -> Column:
        n = F.element_at(words, WORDS)
        lanes = F.flatten(F.transform(F.slice(words, HASH_WORDS + 1, WORDS - HASH_WORDS - 1), lambda w: F.array(*[
            F.shiftrightunsigned(w, _ROOM * i).bitwiseAND(F.lit((1 << LANE_BITS) - 1)) for i in range(2)])))
        return F.transform(lanes, lambda v: (2 * v - n).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)

    x, y = sums(one), sums(other)
    size = F.sqrt(dot(x, x) * dot(y, y))
    return F.when(one == other, 1.0).when(size == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(x, y) / size)))


def with_next(docs: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """docs (doc_id, text and more) with next: the given columns of the next row by descending doc_id,
    after the last those of the first. Rows without an id come last; rows of one id go by their texts,
    greatest first. Ids are dealt by their quantiles into buckets; the first row of a bucket follows
    the last of the bucket before as an extra row, so no task sees more than a bucket."""
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("long"))
    bounds = id_bounds(docs, buckets)
    # bucket 0 has the greatest ids; every bucket has a row
    at = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b > key)) if bounds else F.lit(0)
    rows = docs.withColumn("_bucket", at.cast("int")).withColumn("_key", key)
    first_keys = rows.groupBy("_bucket").agg(F.max("_key").alias("_key"))  # at most MOST_BUCKETS rows
    heads = rows.join(F.broadcast(first_keys), ["_bucket", "_key"])
    firsts = heads.groupBy("_bucket").agg(F.max(F.struct("text", *[c for c in columns if c != "text"])).alias("head"))
    n = len(bounds) + 1
    extra = firsts.select(
        F.pmod(F.col("_bucket") - 1, F.lit(n)).cast("int").alias("_bucket"),
        *[(F.col("head")[c] if c in {"text", *columns} else F.lit(None).cast(kind)).alias(c) for c, kind in docs.dtypes],
        F.lit(1).alias("_extra"))
    every = rows.drop("_key").withColumn("_extra", F.lit(0)).unionByName(extra)
    order = Window.partitionBy("_bucket").orderBy("_extra", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    return every.select("*", F.lead(F.struct(*columns)).over(order).alias("next")).filter("_extra = 0").drop("_bucket", "_extra")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half (rounded down) of code points replaced by the first as many, or
    all, of the next row's (see with_next). A NULL text counts as empty, and an empty text is one empty
    paragraph. Other columns of docs, whatever their names, are not read."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    tasks = max(shuffle_tasks(docs.sparkSession), pieces(text_bytes(docs, text_col), BUCKET_BYTES))
    rows = with_fingerprint(rows, "text", "words")
    paired = with_next(rows, ["text", "words"], min(MOST_BUCKETS, tasks)).withColumn("n", F.char_length("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n") - half),
                      F.substring(F.col("next.text"), F.lit(1), half))
    paired = paired.select("doc_id", F.col("n").cast("long").alias("n_chars"), "words", F.col("next.words").alias("next_words"),
                           edited.alias("edited"))
    paired = with_fingerprint(paired, "edited", "edited_words")
    return paired.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), as_text(F.col("words")).alias("fingerprint"),
        as_text(F.col("edited_words")).alias("edited_fingerprint"), likeness(F.col("words"), F.col("edited_words")).alias("near_edited"),
        likeness(F.col("words"), F.col("next_words")).alias("near_next"))
