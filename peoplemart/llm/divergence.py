"""How far the sources of a language differ in the terms they use, by frequent-pattern trees of terms.

A term is a row: its sources in order, each with its count. Rows sorted by these paths form a prefix tree, in
which terms that begin alike share nodes and carry their number. Of two sources a and b, a term adds |p - q|. Written
as a sum over all terms of the value for counts of zero, of a change for each source that has the term, and of a
correction for two sources that both have it, only the last needs pairs: a node is met once with each of its ancestors,
for all terms below it together. Spark cuts the sorted rows into ranges, and each range is a tree that is walked, never
held: only the path from the root to the row at hand is.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.llm.common import runs_of, shipped, shuffle_tasks
from peoplemart.sources.storage import staged

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE = 1_000_000_000
#: Counts of a task are passed on when it holds so many terms, sums of pairs when they are of so many sources.
MOST_TERMS = 200_000
MOST_SOURCES = 2048
_WIDE = "decimal(38,0)"
#: Letters A-Z become small, all else of ASCII parts terms, and bytes of other characters belong to terms.
_FOLD = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def counted_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it) of docs (text, lang, source, none of them NULL)."""
    shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
        held = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in counts.items():
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                     pa.array(list(own), pa.binary()).cast(pa.string()),
                     pa.array([v[0] for v in own.values()], pa.int64()), pa.array([v[1] for v in own.values()], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for begin, end in runs_of(batch["text"]):
                part = batch.slice(begin, end - begin)
                for text, lang, source in zip(*(part[c].to_pylist() for c in ("text", "lang", "source")), strict=True):
                    own = counts[lang, source]
                    before = len(own)
                    for term, n in Counter(terms_of(text)).items():
                        if term in own:
                            own[term][0] += n
                            own[term][1] += 1
                        else:
                            own[term] = [n, 1]
                    held += len(own) - before
                    if held >= MOST_TERMS:
                        yield from passed_on()
                        counts.clear()
                        held = 0
        yield from passed_on()

    found = docs.select("text", "lang", "source").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, words: Column, terms: Column) -> Column:
    """p of a count, exactly; NULL without terms."""
    top = (count.cast(_WIDE) + F.lit(SMOOTHING)) * F.lit(SCALE)
    bottom = F.nullif(words.cast(_WIDE) + terms.cast(_WIDE) * F.lit(SMOOTHING), F.lit(0))
    return F.call_function("div", top, bottom).cast("long") + 1


def corrections(paths: DataFrame, tasks: int) -> DataFrame:
    """lang, a, b and correction: what terms that both sources of a pair have change in the sum of their differences.

    paths: lang, path (array of source, n, p and base, by source) and terms, the number of terms of that path. For one
    term the correction is |p - q| less |p - base of b| and |base of a - q|, plus |base of a - base of b|; since no p lies
    below its base, that is twice the length that the stretches from base to p share, taken off."""
    shipped(paths.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, names, depth = None, {}, 0
        # the path from the root to the row at hand: number of the source, n, p, base, and terms that have ended at or below
        path = np.zeros((5, 64), np.int64)
        sums = np.zeros((64, 64), np.int64)  # by number of the ancestor's source and of the node's

        def leave(upto: int) -> None:
            """Leaves the nodes at depth upto and below it: each has now seen all its terms."""
            nonlocal depth
            source, _, p, base, terms = path[:, :depth]
            terms[upto:] = np.cumsum(terms[upto:][::-1])[::-1]
            if upto < depth:
                shared = np.minimum(p[:, None], p[upto:]) - np.maximum(base[:, None], base[upto:])
                above = np.arange(depth)[:, None] < np.arange(upto, depth)
                # the sources of a path differ
                sums[np.ix_(source, source[upto:])] -= 2 * np.where(above, np.maximum(shared, 0), 0) * terms[upto:]
                if upto:
                    terms[upto - 1] += terms[upto]
            depth = upto

        def summed() -> Iterator[pa.RecordBatch]:
            leave(0)
            upper, lower = np.nonzero(sums)
            known = np.array(list(names), object)
            if len(upper):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(upper), pa.string()), pa.array(known[upper], pa.string()), pa.array(known[lower], pa.string()),
                     pa.array(sums[upper, lower])], ["lang", "a", "b", "correction"])
            names.clear()
            sums[:] = 0

        for batch in batches:
            items = batch["path"].flatten()
            at = np.asarray(batch["path"].offsets) - batch["path"].offsets[0].as_py()
            sources = items.field("source").dictionary_encode()
            texts, which = sources.dictionary.to_pylist(), np.asarray(sources.indices)
            values = np.stack([np.asarray(items.field(name)) for name in ("n", "p", "base")])
            for i, (own, n) in enumerate(zip(batch["lang"].to_pylist(), batch["terms"].to_pylist(), strict=True)):
                begin, length = at[i], at[i + 1] - at[i]
                used = [texts[k] for k in which[begin: at[i + 1]]]
                if own != lang or len(names) + sum(text not in names for text in used) > max(MOST_SOURCES, length):
                    yield from summed()
                    lang = own
                for text in used:
                    names.setdefault(text, len(names))
                if length > path.shape[1]:
                    path = np.pad(path, ((0, 0), (0, length)))
                if len(names) > len(sums):
                    sums = np.pad(sums, (0, len(names)))
                row = np.vstack([[names[text] for text in used], values[:, begin: at[i + 1]], np.zeros(length, np.int64)])
                least = min(depth, length)
                differs = np.flatnonzero((path[:2, :least] != row[:2, :least]).any(0))
                common = int(differs[0]) if len(differs) else least
                leave(common)
                path[:, common: length] = row[:, common:]
                depth = length
                path[4, length - 1] += n
        yield from summed()

    # Rows of one path's beginning are neighbours; a cut between ranges costs the nodes on one path at most. The first
    # items tell ranges apart, and a hash where very many terms begin alike.
    forest = paths.repartitionByRange(tasks, "lang", F.slice("path", 1, 3), F.xxhash64("path")).sortWithinPartitions("lang", "path")
    return forest.mapInArrow(run, "lang string, a string, b string, correction long").groupBy("lang", "a", "b").agg(
        F.sum("correction").alias("correction"))


def _ranked(found: DataFrame) -> DataFrame:
    """With rank from 1 in each group, by value, greatest first, and item."""
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.withColumn("rank", F.row_number().over(order))


def _changes(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """lang, source, other, n (terms of source) and far: the sum of |p - base of other| over the terms of source.

    Of each source the p of its terms and the bases of the others are walked in order together, with running sums."""
    own = items.groupBy("lang", "source", F.col("p").alias("at")).agg(F.count("*").alias("n")).select(
        "lang", "source", "at", "n", (F.col("at") * F.col("n")).alias("sum"), F.lit(None).cast("string").alias("other"))
    others = pairs.select("lang", "source", F.col("other_base").alias("at"), F.lit(0).cast("long").alias("n"),
                          F.lit(0).cast("long").alias("sum"), "other")
    group = Window.partitionBy("lang", "source")
    below = group.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    walked = own.unionByName(others).select(
        "lang", "source", "other", "at", F.sum("n").over(below).alias("n_below"), F.sum("sum").over(below).alias("sum_below"),
        F.sum("n").over(group).alias("n"), F.sum("sum").over(group).alias("sum")).filter("other IS NOT NULL")
    return walked.select("lang", "source", "other", "n", (
        F.col("sum") - 2 * F.col("sum_below") + F.col("at") * (2 * F.col("n_below") - F.col("n"))).alias("far"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: in part 'pair' each other source of the language by the sum of the
    differences over all kept terms, in part 'term' the terms that the source uses more than its language does, the
    first top_terms of them.

    NULL in text, language or source counts as ''. Terms are runs of letters A-Z, lower-cased, and of all characters
    beyond ASCII; a language keeps those in at least least_documents of its rows. Each row is a document, also where
    rows repeat. Texts are read whole. A language without kept terms has value 0 in every pair; a language with one
    source has no pair. Ties go by item, in the order of its UTF-8 bytes. All arithmetic is on integers. An empty table gives no rows;
    other columns of docs, whatever their names, are not read."""
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(name)
                         for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    kept = staged(counted_terms(rows).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("sources"))
        .filter(F.col("docs") >= least_documents).drop("docs"), "terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_words"))
    exploded = kept.select("lang", "term", "lang_n", F.inline("sources"))
    words = exploded.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    groups = rows.select("lang", "source").distinct().join(words, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("words", F.lit(0)).alias("words"), F.coalesce("terms", F.lit(0)).alias("terms"), "lang_words")
    groups = staged(groups.withColumn("base", _share(F.lit(0), F.col("words"), F.col("terms"))), "groups")
    items = staged(exploded.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "base", _share(F.col("n"), F.col("words"), F.col("terms")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_words"), F.col("terms")).alias("q")), "items")

    paths = items.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n", "p", "base"))).alias("path"))
    both = corrections(paths.groupBy("lang", "path").agg(F.count("*").alias("terms")), shuffle_tasks(docs.sparkSession))
    both = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "correction")).withColumnsRenamed(
        {"a": "source", "b": "other"})
    # the result has a row for each two sources of a language
    pairs = groups.join(groups.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base")), "lang").filter(
        F.col("source") != F.col("other")).select("lang", "source", "other", "terms", "base", "other_base")
    far = _changes(items, pairs.filter("terms > 0"))
    there = far.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("n").alias("other_n"), F.col("far").alias("other_far"))
    value = (F.col("far") + F.col("other_far") + F.coalesce("correction", F.lit(0))
             + F.abs(F.col("base") - F.col("other_base")) * (F.col("terms") - F.col("n") - F.col("other_n")))
    by_source = pairs.join(far, ["lang", "source", "other"], "left").join(there, ["lang", "source", "other"], "left").join(
        both, ["lang", "source", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.coalesce(value, F.lit(0)).cast("long").alias("value"))
    by_term = items.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(by_source).unionByName(_ranked(by_term).filter(F.col("rank") <= top_terms))
