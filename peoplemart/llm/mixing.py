"""Mixing sources to target weights, by DataFrame functions alone.

Every document has a hash. Its source's budget is met by a threshold: whole passes over the source, and one more
over the documents whose hash lies below the threshold. The threshold is found without sorting documents: words are
summed by source and the hash's upper bits, the running sums of a source's few buckets show the bucket in which the
budget ends, and that bucket alone is cut by the next bits, until one hash is left. Budgets are nested: of two mixes
with the same weights, all that the smaller one takes is taken by the larger one too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.llm.common import words_of
from peoplemart.operators.keys import dense_keys
from peoplemart.sources.storage import staged

#: Times that a document may be taken.
MOST_PASSES = 3
#: Sources in order weigh so much, over and over.
WEIGHTS = (1, 2, 3)
HASH_DIGITS = 15  # hexadecimal: 60 bits
LEVEL_BITS = 12   # 4,096 buckets of a source at most in each level
_LEVELS = 4 * HASH_DIGITS // LEVEL_BITS
_WIDE = "decimal(38,0)"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words; 0 for NULL) and hash of each row.

    The hash is of id and text, so rows of one id, or without an id, are told apart where their texts differ."""
    text = docs[text_col].cast("string")
    digest = F.md5(F.concat_ws("|", docs[id_col].cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"),
        F.coalesce(F.size(words_of(text)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long").alias("hash"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = 100, passes: int = MOST_PASSES) -> DataFrame:
    """source, source_size, target (double) and goal (long, the target to the nearest word) of the sources of rows.

    Sources in code point order, NULL last, weigh as given, repeating, and divide share per cent of all words; what
    one can't use, since its documents may be taken `passes` times at most, is divided among the others by weight."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_none", F.col("source").isNull())
    place = F.pmod(F.col("_number") - 1, F.lit(len(weights))).cast("int")
    weighed = staged(dense_keys(sources, ["_none", "source"], "_number").select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast(_WIDE).alias("weight"),
        (F.col("source_size").cast(_WIDE) * passes).alias("most")), "sources")
    words = F.sum(F.col("source_size").cast(_WIDE))
    whole = int(weighed.agg(words).first()[0] or 0) * share // 100
    # each round the sources that their even part would fill keep what they can use; the others divide the rest
    rest, over, full = whole, None, F.lit(False)
    while True:
        found = weighed.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        rest, weight = whole - int(found[0] or 0), int(found[1] or 0)
        if found[2] == over:
            break
        over = found[2]
        full = F.col("most") * F.lit(weight).cast(_WIDE) < F.col("weight") * F.lit(rest).cast(_WIDE)
    divided = F.col("weight") * F.lit(rest).cast(_WIDE)
    weight = max(weight, 1)
    return weighed.select(
        "source", "source_size", F.when(full, F.col("most").cast("double")).otherwise(
            divided.cast("double") / F.lit(float(weight))).alias("target"),
        F.when(full, F.col("most")).otherwise(F.call_function("div", divided * 2 + F.lit(weight).cast(_WIDE),
                                                              F.lit(2 * weight).cast(_WIDE))).cast("long").alias("goal"))


def _bucket(level: int) -> Column:
    return F.shiftright("hash", 4 * HASH_DIGITS - LEVEL_BITS * level)


def _cut(rows: DataFrame, edges: DataFrame, level: int) -> DataFrame:
    """edges (source, bucket of the level before, before, budget) a level finer: the bucket in which the
    budget ends, the words of its own and those before it. rows are those of the buckets of edges."""
    inside = rows.alias("r").join(edges.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (_bucket(level - 1) == F.col("e.bucket")))
    sums = inside.groupBy(F.col("r.source").alias("source"), _bucket(level).alias("bucket"), "before", "budget").agg(
        F.sum("size").alias("words"))
    return _ends(sums)


def _ends(sums: DataFrame) -> DataFrame:
    order = Window.partitionBy("source").orderBy("bucket")  # 2^LEVEL_BITS rows of a source
    return sums.withColumn("before", F.col("before") + F.sum("words").over(order) - F.col("words")).filter(
        (F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("words")))


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with passes (taken by every document of the source) and below (documents of a smaller hash are taken once more).

    The document at the threshold is taken if that brings the source nearer to its goal."""
    size = F.nullif(F.col("source_size"), F.lit(0))
    goals = goals.withColumn("passes", F.coalesce(F.call_function("div", F.col("goal"), size), F.lit(0))).withColumn(
        "budget", F.coalesce(F.pmod(F.col("goal"), size), F.lit(0)))
    sums = rows.groupBy("source", _bucket(1).alias("bucket")).agg(F.sum("size").alias("words"))
    budgets = goals.select(F.col("source").alias("of"), "budget")
    first = sums.join(budgets, F.col("source").eqNullSafe(F.col("of"))).withColumn("before", F.lit(0).cast("long"))
    edges = staged(_ends(first.select("source", "bucket", "before", "budget", "words")), "edges")
    # of each source one bucket in 2^LEVEL_BITS is looked at again
    rest = rows.alias("r").join(edges.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (_bucket(1) == F.col("e.bucket")))
    inside = staged(rest.select("r.source", "r.hash", "r.size"), "inside")
    for level in range(2, _LEVELS + 1):
        edges = _cut(inside, edges, level)
    nearer = 2 * F.col("budget") > 2 * F.col("before") + F.col("words")
    found = edges.select(F.col("source").alias("of"), (F.col("bucket") + nearer.cast("long")).alias("below"))
    return goals.join(found, F.col("source").eqNullSafe(F.col("of")), "left").drop("of").withColumn(
        "below", F.coalesce(F.col("below"), F.lit(0)))


def mixed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (source, hash, size and more) with source_size, target, copies (times the row is taken) and taken (words)."""
    plan = plan.select(F.col("source").alias("_source"), "source_size", "target", "passes", "below")
    found = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    copies = F.col("passes") + (F.col("hash") < F.col("below")).cast("long")
    return found.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("_source", "passes", "below")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: int = 100, passes: int = MOST_PASSES) -> DataFrame:
    """doc_id, source, size, hash, source_size, target, copies and taken of each row of docs.

    share is the mix's words as a percentage of all words, `passes` the times a document may be taken. A NULL text has
    no words, a NULL source is a source of its own, the last. Texts are read whole and taken whole, so a source misses
    its target by half its largest document at most. Rows that agree in id and text are taken or left together. Equal
    inputs give equal results however rows are ordered. A source without words has target 0. An empty table gives no
    rows; other columns of docs, whatever their names, are not read."""
    rows = staged(sized(docs, id_col, text_col, source_col), "sizes")  # the texts are read once
    return mixed(rows, staged(thresholds(rows, targets(rows, weights, share, passes)), "plan"))


def expanded(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of the mix: each row of docs as often as found (of mix) takes its id, with copy (from 1).

    A column copy of docs gives way. Ids must be unique; rows of an id that isn't taken, or without an id, are not in it."""
    taken = found.filter("copies > 0").select(F.col("doc_id").alias("_of"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    docs = docs.drop("copy")
    return docs.join(taken, docs[id_col].cast("long") == taken["_of"]).drop("_of")
