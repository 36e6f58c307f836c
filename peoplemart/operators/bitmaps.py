"""Sets of whole-number keys as bitmaps: a row holds 32,768 neighbouring keys, a bit for each.

Surrogate keys are dense, so a bitmap is 64 times smaller than its keys. Bitmaps of parts (years, files) are merged
by OR, so exact distinct counts need no row per member after the first fold, and whether a key is known is a
look-up in a table of one row for 32,768 keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_KEYS = 32_768
BUCKET_BYTES = BUCKET_KEYS // 8
_BUCKET, _BITS = "_bucket", "_bits"


def bucket_of(key: str | Column) -> Column:
    return F.bitmap_bucket_number(key)


def buckets_within(least: int, greatest: int) -> int:
    """The most buckets that keys of a closed range can have."""
    return (greatest - least) // BUCKET_KEYS + 2


def member_bitmaps(df: DataFrame, groups: list[str], key: str, *sums: Column) -> DataFrame:
    """The distinct keys of each group as bitmaps, a row per group and bucket, and sums over its rows.

    NULL is no key; its rows still count in the sums. The fold on the map side goes through sorted rows, one bitmap at a time."""
    return df.withColumn(_BUCKET, bucket_of(key)).groupBy(*groups, _BUCKET).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(_BITS), *sums)


def merged_bitmaps(bitmaps: DataFrame, groups: list[str], *sums: Column) -> DataFrame:
    """Bitmaps of finer groups, for instance of single years, as those of groups."""
    return bitmaps.groupBy(*groups, _BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS), *sums)


def member_counts(bitmaps: DataFrame, groups: list[str], name: str, *sums: Column) -> DataFrame:
    """The distinct keys of each group, from a row per group and bucket."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count(_BITS)).alias(name), *sums)


#: The eight bytes of _bits from byte 8 i on as one number, the first byte on top.
_WORD = " | ".join(f"shiftleft(CAST(conv(hex(substring(_bits, i * 8 + {first}, 4)), 16, 10) AS BIGINT), {shift})" for first, shift in ((1, 32), (5, 0)))


def known_keys(df: DataFrame, column: str, suffix: str = "") -> DataFrame:
    """The keys of a column as _bucket and _words (with suffix): of 32,768 keys 512 numbers of 64 bits, in which a bit
    is found without a copy. Rows of no key have no bucket."""
    folded = df.selectExpr(f"bitmap_bucket_number({column}) AS {_BUCKET}{suffix}", f"bitmap_bit_position({column}) AS _at")
    folded = folded.groupBy(f"{_BUCKET}{suffix}").agg(F.expr(f"bitmap_construct_agg(_at) AS {_BITS}"))
    return folded.selectExpr(f"{_BUCKET}{suffix}", f"transform(sequence(0, {BUCKET_BYTES // 8 - 1}), i -> {_WORD}) AS _words{suffix}")


def is_in(words: str, key: str) -> str:
    """An expression: whether the words of a key's bucket hold it; false without a bucket."""
    at = f"bitmap_bit_position({key})"
    bit = f"CAST((7 - (shiftright({at}, 3) & 7)) * 8 + ({at} & 7) AS INT)"
    return f"coalesce(getbit(get({words}, CAST(shiftright({at}, 6) AS INT)), {bit}) = 1, false)"
