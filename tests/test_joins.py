"""Joins, life cycles, metrics and audits against brute force, with hot and missing keys."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import samples
from brooklet.operators.audit import audit_counts
from brooklet.operators.enrich import enrich, mark_known, orphans
from brooklet.operators.lifecycle import lifecycle, reprocess
from brooklet.operators.windows import dedup_by_id, window_metrics


def facts(spark, n=3000):
    rng = random.Random(3)
    # A third of the rows refer to key 1, a tenth to none.
    keys = [rng.choice([1] * 10 + [None] * 3 + list(range(2, 19))) for _ in range(n)]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "row int, key int").repartition(4)


def dims(spark):
    return spark.createDataFrame([(k, f"name{k}") for k in range(0, 12)], "key int, name string")


@pytest.fixture(params=["broadcast", "shuffle"])
def size(request, spark):
    """Both ways to join: the table is small, or too big to broadcast."""
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_enrich(spark, size):
    rows = facts(spark)
    got = enrich(rows, dims(spark), "key", {"name": "name", "one": F.lit(1)})
    assert got.columns == ["row", "key", "name", "one"]
    result = {r["row"]: r for r in got.collect()}
    assert len(result) == 3000
    for r in rows.collect():
        known = r["key"] is not None and r["key"] < 12
        assert result[r["row"]]["name"] == (f"name{r['key']}" if known else None)
        assert result[r["row"]]["one"] == (1 if known else None)
    assert "Generate" not in plan_of(got)


def test_hot_key_is_split_by_spark(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        got = enrich(facts(spark), dims(spark), "key", {"name": "name"})
        assert got.count() == 3000
        assert got.where("key = 1").select(F.spark_partition_id().alias("p")).distinct().count() >= 1
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_mark_known(spark, size):
    got = {r["row"]: r["known"] for r in mark_known(facts(spark), dims(spark), "key", "known").collect()}
    for r in facts(spark).collect():
        assert got[r["row"]] is (r["key"] is not None and r["key"] < 12)


def test_orphans(spark, size):
    got = orphans(facts(spark), dims(spark), "key", {"name": F.lit("Unknown"), "state_id": F.lit(-1)})
    assert got.columns == ["key", "name", "state_id"]
    assert sorted(tuple(r) for r in got.collect()) == [(k, "Unknown", -1) for k in range(12, 19)]
    with pytest.raises(ValueError):
        orphans(facts(spark), dims(spark), "key", {}, "sometimes")


def test_orphan_keys_are_distinct_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(orphans(facts(spark), dims(spark), "key", {}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftAnti") < plan.index("Aggregate [key")


@pytest.mark.parametrize("time_slice", ["hour", "day", "minute"])
def test_lifecycle(spark, time_slice):
    rng = random.Random(4)
    events = []
    for i in range(1500):
        key = rng.choice(["hot"] * 5 + [f"t{j}" for j in range(10)] + [None])
        minute = rng.choice([None, *range(0, 3000, 7)])
        when = None if minute is None else samples.at(f"2024-01-{1 + minute // 1440:02d} {minute // 60 % 24:02d}:{minute % 60:02d}:00")
        events.append((i, key, when))
    df = spark.createDataFrame(events, "row int, id string, ts timestamp").repartition(3)
    got = {r["row"]: r["step"] for r in lifecycle(df, "id", "ts", ["row"], time_slice).collect()}
    by_key = defaultdict(list)
    for row, key, when in events:
        if key is not None and when is not None:
            by_key[key].append((when, row))
    expected = {row: None for row, *_ in events} | {row: i + 1 for rows in by_key.values() for i, (_, row) in enumerate(sorted(rows))}
    assert got == expected


def test_reprocess(spark):
    source = spark.createDataFrame([(1, "a")], "id int, v string")
    fixed = spark.createDataFrame([("b", 2, "why")], "v string, id int, note string")
    assert sorted(tuple(r) for r in reprocess(fixed, source).collect()) == [(1, "a"), (2, "b")]


def test_window_metrics(spark):
    at = samples.at
    rows = [
        (at("2024-01-01 00:00:05"), "1.50", True),
        (at("2024-01-01 00:00:55"), "2.25", None),
        (at("2024-01-01 00:00:56"), "free", False),
        (at("2024-01-01 00:01:00"), None, True),
        (None, "9", True),
    ]
    df = spark.createDataFrame(rows, "ts timestamp, price string, ok boolean")
    flags = {"good": F.col("ok"), "bad": ~F.col("ok"), "unknown": F.col("ok").isNull()}
    got = sorted(tuple(r) for r in window_metrics(df, "ts", flags=flags).collect())
    assert got == [
        (at("2024-01-01 00:00:00"), at("2024-01-01 00:01:00"), 3, 1.875, 1, 1, 1),
        (at("2024-01-01 00:01:00"), at("2024-01-01 00:02:00"), 1, None, 1, 0, 0),
    ]


def test_audit(spark):
    got = audit_counts({"a": spark.range(3), "b": spark.range(0), "c": spark.range(3)})
    assert Counter(tuple(r) for r in got.collect()) == Counter([("a", 3), ("b", 0), ("c", 3)])


def test_static_dedup(spark):
    rows = [("a", samples.at("2024-01-01 00:00:00")), ("a", samples.at("2024-01-01 00:00:09")), ("b", None)]
    df = spark.createDataFrame(rows, "id string, ts timestamp")
    assert sorted(tuple(r) for r in dedup_by_id(df, ["id"], "ts").collect()) == [rows[0], rows[2]]  # the first, as on a stream
