"""The plans behind the promises on scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brooklet.operators.latest import latest
from brooklet.plans.card import routed
from brooklet.plans.queries import QUERIES
from brooklet.schemas import LONG, TEXT, TRANSACTION, TableSpec, struct
from brooklet.sources.messages import parse_json
from brooklet.streaming.upsert import UpsertTable

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables here")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


@needs_tables
@pytest.mark.parametrize("name", ["valid_transactions", "validation_flags", "json_parse", "csv_payload"])
def test_row_by_row_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF_DIR))


@needs_tables
def test_counts_read_one_column_and_fold_before_the_shuffle(spark):
    plan = plan_of(QUERIES["ops_metadata_1min"](spark, SF_DIR))
    assert [c.split(":")[0] for c in read_columns(plan)[0].split(",")] == ["ts"]
    assert "IsNotNull(ts)" in plan
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_count")


@needs_tables
def test_orphans_read_only_the_key_of_the_static_table(spark):
    plan = plan_of(QUERIES["customer_orphans"](spark, SF_DIR))
    assert "c_custkey:bigint" in read_columns(plan)
    assert "LeftAnti, BuildRight" in plan


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_row_by_row_python(spark, name):
    if name.endswith("_stream") or name in ("upsert_log", "offload_old_months", "static_json_table"):
        pytest.skip("writes before it reads")
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroups"):
        assert node not in plan


def test_validated_json_is_parsed_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = plan_of(routed(parse_json(lines, TRANSACTION))["valid"])
    assert plan.count("from_json(") == 1


def test_last_row_is_folded_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = plan_of(latest(rows, ["k"], ["o"]))
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_max")


def test_base_of_a_keyed_table_is_not_shuffled(spark, tmp_path):
    spec = TableSpec("t", struct(id=LONG, v=TEXT), ("id",), buckets=2)
    table = UpsertTable(spark, str(tmp_path), spec)
    table.load(spark.range(100).select("id", F.lit("a").alias("v")))
    table.compact(settled=True)
    table.load(spark.range(3).select("id", F.lit("b").alias("v")))
    frame = table.read()
    assert frame.count() == 100 and frame.where("v = 'b'").count() == 3
    plan = plan_of(frame)
    join = plan[plan.index("LeftAnti, BuildRight") :]
    # Between the join and the scan of the base there is no exchange.
    assert "Exchange" not in join[: join.index("FileScan")]


def test_writing_a_batch_does_not_shuffle(spark, tmp_path):
    spec = TableSpec("t", struct(id=LONG, v=TEXT), ("id",), buckets=2)
    table = UpsertTable(spark, str(tmp_path), spec)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-batch", "one batch")
    try:
        table.write_batch(spark.range(1000, numPartitions=4).select("id", F.lit("a").alias("v")), 0)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("one-batch")]
    assert sum(len(j.stageIds) for j in jobs) == 1
