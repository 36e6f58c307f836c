"""Dense surrogate keys 1..N in the order of a unique natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.sources.session import shuffle_parts
from peoplemart.sources.storage import staged

# monotonically_increasing_id: the partition number is above these bits, the row number in them
_ROW_BITS = 33


def dense_keys(df: DataFrame, order: list[str], key: str, columns: list[str | Column] | None = None) -> DataFrame:
    """df, or these columns of it, with a leading column `key` numbering its rows by `order`, which must be unique.

    Columns that follow from others are best given as expressions here: they are computed after the shuffle.
    The rows are range partitioned, numbered within their partition and shifted by the rows of the
    partitions before it, so no task sees more than its range.
    """
    parts = max(2, shuffle_parts(df.sparkSession))
    columns = df.columns if columns is None else columns
    # The row positions must not change between the count and the shift, so they are written once.
    ranged = staged(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(*columns, F.monotonically_increasing_id().alias("_at")),
        "ranged",
    )
    part = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, `parts` at most
    shifts = (
        ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select("_part", "_shift")
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")
        .select((F.col("_shift") + row + 1).alias(key), *[c for c in ranged.columns if c != "_at"])
    )
