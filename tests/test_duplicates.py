"""Repeated values by a prefilter of hashed buckets."""

import random
import uuid
from collections import Counter

from pyspark.sql import functions as F

from peoplemart.operators import checks, duplicates
from tests.test_scale import conf, plan_of  # noqa: F401


def shuffled_records(spark, df):
    """The result of df and the records that its jobs wrote to shuffles."""
    group = f"measured {uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, group)
    rows = df.collect()
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {stage for job in tracker.getJobIdsForGroup(group) for stage in tracker.getJobInfo(job).stageIds}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return rows, sum(store.lastStageAttempt(stage).shuffleWriteRecords() for stage in stages)


def test_repeated_values_are_those_of_plain_counting(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, rng.randrange(4000)]), rng.choice(["a", "b", None, ""])) for _ in range(6000)]
    rows += [(77, "hot")] * 3000
    table = spark.createDataFrame(rows, "k long, t string").repartition(7)
    for columns in (["k"], ["t"], ["k", "t"]):
        plain = Counter(tuple(r[0 if c == "k" else 1] for c in columns) for r in rows)
        found = {tuple(r)[:-1]: r.Filas for r in checks.repeated(table, columns).collect()}
        assert found == {v: n for v, n in plain.items() if n > 1}
    keys = Counter(k for k, _ in rows)
    report = checks.key_report(table, "T", "k").first()
    assert report.Problemas == keys.pop(None) + sum(n > 1 for n in keys.values())
    one_missing = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    assert checks.key_report(one_missing, "T", "k").first().Problemas == 1
    assert checks.key_report(one_missing.limit(0), "T", "k").first().Problemas == 0


def test_values_of_one_hash_are_told_apart(spark, monkeypatch):
    """With one bucket and equal hashes everything is suspect, and still grouped exactly."""
    monkeypatch.setattr(duplicates, "MOST_BUCKETS", 1)
    table = spark.range(500).select((F.col("id") % 499).alias("k"))
    assert [tuple(r) for r in checks.repeated(table, ["k"]).collect()] == [(0, 2)]
    assert duplicates.suspect_rows(table, ["k"]).count() == 500


def test_rows_of_unique_keys_are_not_shuffled(spark, conf):  # noqa: F811
    table = spark.range(0, 400_000, 1, 4).select(F.col("id").alias("k"), F.concat(F.lit("mail"), "id").alias("t"))
    for column in ("k", "t"):
        rows, total = shuffled_records(spark, checks.key_report(table, "T", column))
        assert rows[0].Problemas == 0 and 0 < total < 0.05 * 400_000
    twice = table.unionAll(table.filter("k = 5"))
    rows, total = shuffled_records(spark, checks.key_report(twice, "T", "k"))
    assert rows[0].Problemas == 1 and total < 0.05 * 400_000
    assert duplicates.suspect_rows(twice, ["k"]).count() < 2000
    plan = plan_of(checks.repeated(table, ["t"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
