"""A corpus pipeline over documents: each stage works on what the one before kept."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplemart.llm import language, packing, secret_scan, simhash, substrings
from peoplemart.llm.common import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: What 99 % of held-out rows reach, and a share of the way from chance (1 / labels) to it: the least score that keeps a document.
HELD_OUT_REJECTED = 0.01
SHARE_OVER_CHANCE = 0.6
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(found: DataFrame, text_col: str) -> DataFrame:
    """The columns of documents, with the text that a stage made."""
    return found.withColumn("text", F.col(text_col)).withColumn(
        "n_chars", F.char_length(F.col(text_col)).cast("long")).select(*COLUMNS)


def score_of_rank(scored: DataFrame, share: float) -> float | None:
    """The score that stands at this share of all rows, the least first (to 2**-32); None without rows. Rows are
    counted by the upper and then, where the rank lies, by the lower half of 32 bits, so the driver gets 2**16 counts."""
    at = F.floor(F.col("score") * F.lit(float(1 << 32))).cast("long")
    steps = sorted(scored.groupBy(F.shiftright(at, 16).alias("step")).agg(F.count("*").alias("n")).collect())
    rank = max(1, math.ceil(share * sum(r.n for r in steps)))
    for step, n in steps:
        if rank <= n:
            inside = scored.filter(F.shiftright(at, 16) == step).groupBy(at.alias("step"))
            for _, m, least in sorted(inside.agg(F.count("*").alias("n"), F.min("score").alias("least")).collect()):
                if rank <= m:
                    return least
                rank -= m
        rank -= n
    return None


def least_language_score(network: language.Network, docs: DataFrame) -> float:
    """Over chance for any number of labels, and below what nearly all held-out rows with a label reach, by the
    scores of all of them, which are written once. With one label every text scores 1, so none can be told apart."""
    known = docs.filter(language.held_out(F.col("doc_id")) & F.col("lang").isin(network.labels))
    folder = shared_folder(docs.sparkSession, "held_out_scores")
    language.identified_by(network, known).filter(F.col("lang_pred") != language.UNKNOWN).select("score").write.parquet(folder)
    usual = score_of_rank(docs.sparkSession.read.parquet(folder), HELD_OUT_REJECTED)
    chance = 1 / len(network.labels)
    return chance + SHARE_OVER_CHANCE * ((1.0 if usual is None else usual) - chance)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts of no learned language: none (NULL), without a letter, or of a score that few texts of
    the learned languages have. No row has a language if nothing is labelled."""
    words, labels = language.sample(docs, "doc_id", "text", "lang")
    network = language.trained(words, labels) if words else None
    least = least_language_score(network, docs) if network else 1.0
    found = language.identified_by(network, docs)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least)).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, by three-word shingles and two bits, one row stays, of the smallest id."""
    return simhash.first_of_groups(docs).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a smaller id has too go."""
    return _documents(substrings.without_repeats(docs), "kept_text")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mark takes the place of each secret."""
    return _documents(secret_scan.secrets(docs), "redacted_text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batches: which words of which document stand in which batch of which bucket."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: A trained network and iterated links are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's result is written, and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
