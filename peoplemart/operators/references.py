"""Counting rows whose references do not resolve, in one scan of the referring table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplemart.functions.numeric import how_many
from peoplemart.operators.bitmaps import BUCKET_BYTES, buckets_within, is_in, known_keys
from peoplemart.sources.schemas import Reference

#: Bitmaps of a parent's keys are sent to every executor up to this size: about two milliards of dense keys.
MOST_BITMAP_BYTES = 256 << 20


def lost(number: int) -> str:
    """The profile's column with the rows whose reference of that number has a value the parent lacks."""
    return f"_lost_{number}"


def reference_profile(
    df: DataFrame,
    references: Sequence[Reference],
    parents: Mapping[str, DataFrame],
    counters: Mapping[str, Column],
) -> DataFrame:
    """One row: Filas (rows), Huerfanas (rows with any reference that is NULL or lost), the counters,
    and for each reference the rows that lost it; there, NULL refers to nothing and isn't lost.

    One scan. A parent whose range of keys is known without reading it (parents.key_range) and narrow enough is a table of
    bitmaps that every executor gets, so no row of df is shuffled for it. Of the others the distinct values are joined:
    broadcast where their files are small, else by a shuffle, in which adaptive execution splits the rows of a hot key.
    """
    rows = df.select(
        *[F.col(r.column).alias(f"_to_{i}") for i, r in enumerate(references)],
        *[condition.alias(name) for name, condition in counters.items()])
    fitting = {i for i, r in enumerate(references) if _fits(parents, r)}
    # bitmaps last: they never travel through an exchange with the rows
    for i in sorted(range(len(references)), key=lambda i: i in fitting):
        parent, column = parents[references[i].parent], references[i].parent_column
        if i in fitting:
            known = F.broadcast(known_keys(parent, column, f"_{i}"))
            rows = rows.join(known, F.expr(f"bitmap_bucket_number(_to_{i}) = _bucket_{i}"), "left")
        else:
            # distinct over one column more, so that the join deals both sides anew and can split a hot key
            known = parent.selectExpr(f"{column} AS _known_{i}", f"hash({column}) AS _hash_{i}").filter(f"_known_{i} IS NOT NULL").distinct()
            rows = rows.join(known, F.expr(f"_to_{i} = _known_{i}"), "left")
    rows = rows.selectExpr(*[f"_to_{i}" for i in range(len(references))], *counters, *[
        f"{is_in(f'_words_{i}', f'_to_{i}') if i in fitting else f'_known_{i} IS NOT NULL'} AS _found_{i}" for i in range(len(references))])
    found = [F.col(f"_found_{i}") for i in range(len(references))]
    broken = F.lit(False)
    for known in found:
        broken = broken | ~known
    return rows.agg(
        F.count("*").alias("Filas"), how_many(broken).alias("Huerfanas"),
        *[how_many(F.col(name)).alias(name) for name in counters],
        *[how_many(~known & F.col(f"_to_{i}").isNotNull()).alias(lost(i)) for i, known in enumerate(found)])


def _fits(parents: Mapping[str, DataFrame], reference: Reference) -> bool:
    """Whether the bitmaps of a parent's keys have a size that is known to be small enough."""
    key_range = getattr(parents, "key_range", None)
    span = key_range(reference.parent, reference.parent_column) if key_range else None
    whole = parents[reference.parent].schema[reference.parent_column].dataType.typeName() in ("integer", "long")
    return whole and span is not None and buckets_within(*span) * BUCKET_BYTES <= MOST_BITMAP_BYTES


def orphans(child: DataFrame, reference: Reference, parent: DataFrame) -> DataFrame:
    """Referred values that the parent lacks, with the rows that carry them (Filas).

    NULL refers to nothing and is not an orphan.
    """
    column = reference.column
    referred = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("Filas"))
    known = parent.select(F.col(reference.parent_column).alias(column))
    return referred.join(known, column, "left_anti")
