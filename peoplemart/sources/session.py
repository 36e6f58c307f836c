"""Session options for loads that are much larger than the defaults of Spark expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_READ_BYTES = "spark.sql.files.maxPartitionBytes"
_MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Bytes of Parquet files for a shuffle partition: rows take some ten times as much in memory, and a join and a window sort them at once.
_FILE_BYTES = 8 * 1024 * 1024
_PARTITION_BYTES = 128 * 1024 * 1024


def cluster_options(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Options for a load whose largest shuffle moves about shuffled_bytes on cores in total.

    Shuffles start with partitions of about 128 MB, so that each one sorts and aggregates in
    memory, and with at least two per core. Adaptive execution merges those that turn out
    small and splits the partitions of hot keys in joins.
    """
    partitions = max(2 * cores, -(-shuffled_bytes // _PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_PARTITION_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def shuffle_parts(spark: SparkSession) -> int:
    """How many partitions a shuffle begins with, before adaptive execution merges small ones."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(_FIRST_PARTITIONS, None) or 0))


def fit_shuffles(spark: SparkSession, file_bytes: int) -> None:
    """Lets the shuffles of spark begin with a partition for 8 MB of input files at least, which adaptive execution merges up to
    16 MB. It splits none outside of joins, so with a fixed number a task's sorts would grow with the input and spill. Files
    are read 16 MB at a time too: some aggregates and windows sort what a task reads before the shuffle.
    Options that ask for smaller partitions stay, and for small inputs all do."""
    parts = -(-file_bytes // _FILE_BYTES)
    if parts > shuffle_parts(spark):
        spark.conf.set(_FIRST_PARTITIONS, str(parts))
        for option in (_MERGED_BYTES, _READ_BYTES):
            size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(option))
            spark.conf.set(option, str(min(size, 2 * _FILE_BYTES)))
