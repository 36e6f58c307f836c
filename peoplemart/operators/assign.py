"""Assignment of events to entities, first-of-pair enrolment, managers per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peoplemart.operators.keys import dense_keys
from peoplemart.sources.storage import staged


def round_robin(events: DataFrame, event_id: str, entities: DataFrame, entity_id: str) -> DataFrame:
    """Pairs (event, entity): the n-th event goes to entity ((n - 1) mod M) + 1 of M.

    Both sides are numbered by their id, then joined on the computed entity number. Few entities share
    many events each; such a side is a small file, which the planner broadcasts.
    """
    numbered_events = dense_keys(events.select(event_id), [event_id], "n")
    numbered_entities = dense_keys(entities.select(entity_id), [entity_id], "rn")
    size = entities.agg(F.count("*")).scalar()
    turn = ((F.col("n") - 1) % size + 1).alias("rn")
    return (
        numbered_events.select(event_id, "n", turn)
        .join(numbered_entities, "rn")
        .select("n", event_id, entity_id)
    )


def first_of_each(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first row of every group in the given order, which must be total within a group.

    Spark filters each map task down to one row per group before the shuffle
    (WindowGroupLimit), so a group that holds most rows costs no more than any other.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def group_heads(members: DataFrame, group: str, member_id: str) -> DataFrame:
    """One row per group: the member with the lowest id is its head."""
    return members.groupBy(group).agg(F.min(member_id).alias("HeadID"))


def with_managers(members: DataFrame, heads: DataFrame, group: str, member_id: str, manager: str) -> DataFrame:
    """members with the head of their group as manager; a head has none."""
    boss = F.when(F.col(member_id) != F.col("HeadID"), F.col("HeadID"))
    return members.join(heads, group).withColumn(manager, boss).drop("HeadID")


def managers_of(members: DataFrame, group: str, member_id: str, manager: str) -> DataFrame:
    """Heads found and joined back in one step."""
    heads = staged(group_heads(members, group, member_id), "heads")
    return with_managers(members, heads, group, member_id, manager)
