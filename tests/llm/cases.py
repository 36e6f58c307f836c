"""Awkward inputs for the training-data operators, and plain versions of what several of them mean."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names operators use within.
CLASHING = "block int, row string, key long, fp long, words int, n_words string, score string, r0 int, c0 int, part string, half int"
_CLASHES = (7, "x", 1, 2, 3, "w", "s", 4, 5, "p", 6)


def sentence(rng: random.Random, n: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def awkward_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    shared = sentence(rng, 60, 5000)
    near = sentence(rng, 120)
    texts: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "ONE two three ẞ"), (7, "\x1c\x85 á \U0001f642"),
        (8, sentence(rng, 20_000)), (9, "x" * 100_000), (10, shared), (11, sentence(rng, 9) + " " + shared + "\n" + sentence(rng, 5)),
        (12, shared), (12, shared), (13, near), (14, near + " tail"), (None, shared), (None, None), (-5, shared + " before all"),
        (2**62, "far " + shared)]
    return texts + [(20 + i, sentence(rng, rng.randint(0, 90))) for i in range(60)]


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    return spark.createDataFrame([(i, t, *_CLASHES) for i, t in rows], f"doc_id long, text string, {CLASHING}")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
