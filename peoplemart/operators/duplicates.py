"""Finding values that repeat, without shuffling the rows of those that don't.

Values are hashed into buckets. Each task folds its rows to one set of hashes a bucket, and the sets are merged: a bucket
with as many rows as hashes holds no value twice. Only rows of the other buckets can repeat, and they alone are grouped
by their values, exactly. So unique keys cost one array a task and bucket, however many copies a hot value has it
is one hash in each set, and two values that share a hash are told apart in the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of a shuffle partition; of 128 MB, each has some ten thousand hashes. The numbers of all buckets can be broadcast.
BUCKETS_EACH = 512
MOST_BUCKETS = 1 << 20


def _hashed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns, _hash, and the bucket of each row."""
    names = ", ".join(f"`{name}`" for name in columns)
    buckets = min(MOST_BUCKETS, BUCKETS_EACH * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.selectExpr(*[f"`{name}`" for name in columns], f"xxhash64({names}) AS _hash").selectExpr(
        "*", f"pmod(_hash, {buckets}) AS _in")


def suspect_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of rows whose values may repeat: all rows of values that do, and hardly any other. Rows with a NULL are among them."""
    rows = _hashed(df, columns)
    missing = " OR ".join(f"`{name}` IS NULL" for name in columns)
    suspect = rows.groupBy("_in").agg(
        F.expr("count(*) > size(collect_set(_hash))").alias("_more"), F.expr(f"count_if({missing}) > 0").alias("_missing")).filter(
        "_more OR _missing").select("_in")
    return rows.join(F.broadcast(suspect), "_in", "left_semi").select(*columns)
