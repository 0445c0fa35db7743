"""Joins with one hot key and no broadcast: the hot partition must be split, and no row lost."""

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import combine, lookup, mutate, rules, sizing

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
}


@contextmanager
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(sizing, "estimated_bytes", lambda df: 1 << 60)
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def facts(spark):
    """A third of the rows have one key, and another third have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    return spark.range(0, 30_000, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_lookup(spark, facts, monkeypatch):
    table = spark.range(997).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    table = table.union(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
    with no_broadcast(spark, monkeypatch):
        rows, plan = final_plan(lookup.lookup(facts, table, ["k"], ["v"]))
    assert "SortMergeJoin(skew=true)" in plan
    found = Counter("none" if r["v"] is None else "hot" if r["v"] == -1 else "other" for r in rows)
    assert found == {"hot": 10_000, "none": 10_000, "other": 10_000}


def test_rules_full_outer(spark, facts, monkeypatch):
    known = spark.createDataFrame([(1, "hot"), (2, "gone"), (3, "k1")], "mapping_rule_column_group_id int, k string")
    with no_broadcast(spark, monkeypatch):
        rows, plan = final_plan(rules.rules_full_outer(facts, known, ["k"]))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 30_001
    assert Counter(r["mapping_rule_column_group_id"] for r in rows)[1] == 10_000


def test_upsert(spark, facts, monkeypatch):
    changes = spark.createDataFrame([("hot", "new"), ("fresh", "new")], "k string, pad string")
    with no_broadcast(spark, monkeypatch):
        merged = mutate.upsert(
            facts, changes, ["k"], {"pad": F.col("change.pad")}, {"k": F.col("k"), "pad": F.col("pad"), "id": F.lit(-1)}
        )
        rows, plan = final_plan(merged)
    assert plan.count("SortMergeJoin(skew=true)") >= 2  # the update and the match of known keys
    assert len(rows) == 30_001 and sum(r["pad"] == "new" for r in rows) == 10_001


def test_except_rows(spark, facts, monkeypatch):
    monkeypatch.setattr(combine, "COPIES_PER_PIECE", 1000)
    keys = facts.select("k")
    gone = spark.createDataFrame([("hot",), (None,), (None,), ("absent",)], "k string")
    with no_broadcast(spark, monkeypatch):
        rows, plan = final_plan(combine.except_rows(keys, gone))
    assert plan.count("SortMergeJoin(skew=true)") >= 2  # anti join and inner join
    left = Counter(r["k"] for r in rows)
    assert (left["hot"], left[None], sum(left.values())) == (9_999, 9_998, 29_997)


def test_missing_rules_and_presence(spark, facts, monkeypatch):
    wide = facts.select(F.col("id").alias("mapping_rule_column_group_id"), F.col("k"), F.col("pad"))
    data = spark.range(0, 997 * 3).select(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")).alias("k"))
    with no_broadcast(spark, monkeypatch):
        rows, plan = final_plan(rules.missing_rules(wide, data, ["k"]))
        flagged, flag_plan = final_plan(rules.with_presence(wide, data, ["k"], "there"))
    assert "SortMergeJoin(skew=true)" in plan and "SortMergeJoin(skew=true)" in flag_plan
    assert Counter(r["k"] for r in rows) == {"hot": 10_000, "": 10_000}
    assert Counter(r["there"] for r in flagged) == {True: 10_000, False: 20_000}
