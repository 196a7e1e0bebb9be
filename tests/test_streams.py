"""Restart, late rows, de-duplication, query groups and the other sinks."""

import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import samples
from brooklet.operators.enrich import enrich
from brooklet.operators.windows import count_by_window, dedup_by_id
from brooklet.plans.card import routed
from brooklet.schemas import FIRST as KEEP_FIRST, INT, TABLES, TEXT, TIME, TRANSACTION, TableSpec, struct
from brooklet.sources.files import json_dir_stream, message_dir_stream, parquet_stream
from brooklet.sources.messages import parse_json
from brooklet.streaming.group import Output, QueryGroup
from brooklet.streaming.sinks import (
    Maintenance,
    Sink,
    checkpoint_path,
    csv_sink,
    memory_sink,
    message_sink,
    to_messages,
    upsert_sink,
)
from brooklet.streaming.upsert import UpsertTable

TICK = struct(id=TEXT, ts=TIME)


def tick_files(directory, files):
    lines = [
        ['{"id": "%s", "ts": "2024-01-01 %s"}' % row for row in rows] for rows in files
    ]
    samples.write_in_order(directory, lines)


def counted(spark, directory, checkpoint, name, delay="10 seconds"):
    source = json_dir_stream(spark, directory, files_per_trigger=1)
    build = lambda: count_by_window(source(TICK), "ts", delay=delay)
    group = QueryGroup(
        spark, [Output(build, memory_sink(name, "update"))], checkpoint, available_now=True
    )
    group.start()
    group.drain()
    last = spark.table(name).groupBy("start_ts").agg(F.max("num_transactions").alias("n"))
    return {str(r["start_ts"])[11:16]: r["n"] for r in last.collect()}


FIRST = [("a", "00:05:30")]
SECOND = [("b", "00:05:40")]
LATE = [("c", "00:01:00"), ("d", "00:05:35")]
END = [("e", "00:20:00")]


def test_late_row_is_dropped_two_batches_after_the_watermark_moved(spark, tmp_path):
    tick_files(f"{tmp_path}/in", [FIRST, SECOND, LATE, END])
    got = counted(spark, f"{tmp_path}/in", f"{tmp_path}/cp", "late_dropped")
    assert got == {"00:05": 3, "00:20": 1}


def test_late_row_is_counted_in_the_next_batch(spark, tmp_path):
    tick_files(f"{tmp_path}/in", [FIRST, LATE, END])
    got = counted(spark, f"{tmp_path}/in", f"{tmp_path}/cp", "late_counted")
    assert got == {"00:01": 1, "00:05": 2, "00:20": 1}


def test_rows_within_the_delay_always_count(spark, tmp_path):
    files = [[("a", "00:05:30")], [("b", "00:05:25")], [("c", "00:05:21")], [("d", "00:05:29")]]
    tick_files(f"{tmp_path}/in", files)
    assert counted(spark, f"{tmp_path}/in", f"{tmp_path}/cp", "in_time") == {"00:05": 4}


def test_rows_without_time_count_nowhere(spark):
    rows = spark.createDataFrame([("a", None), ("b", samples.at("2024-01-01 00:00:30"))], TICK)
    assert [r["num_transactions"] for r in count_by_window(rows, "ts").collect()] == [1]


@pytest.mark.parametrize("salts", [1, 4])
def test_equal_ids_count_once(spark, tmp_path, salts):
    files = [[("a", "00:05:30"), ("a", "00:05:31")], [("a", "00:05:32"), ("b", "00:05:33")]]
    tick_files(f"{tmp_path}/in", files)
    source = json_dir_stream(spark, f"{tmp_path}/in", files_per_trigger=1)
    build = lambda: dedup_by_id(source(TICK), ["id"], "ts", "1 minute", salts)
    group = QueryGroup(
        spark, [Output(build, memory_sink(f"unique{salts}"))], f"{tmp_path}/cp", available_now=True
    )
    group.start()
    group.drain()
    assert sorted(r["id"] for r in spark.table(f"unique{salts}").collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        dedup_by_id(source(TICK), ["id"], "ts")


PAIR = struct(id=INT, v=TEXT)
PAIRS = TableSpec("pairs", PAIR, ("id",), buckets=1)


def write_pairs(spark, path, rows):
    spark.createDataFrame(rows, PAIR).coalesce(1).write.mode("append").parquet(path)


def pair_group(spark, base, **options):
    table = UpsertTable(spark, f"{base}/table", PAIRS)
    build = lambda: parquet_stream(spark, f"{base}/in")
    return table, QueryGroup(
        spark, [Output(build, upsert_sink(table, **options))], f"{base}/cp", available_now=True
    )


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "a"), (2, "b")])
    table, group = pair_group(spark, tmp_path)
    group.start()
    group.drain()
    write_pairs(spark, f"{tmp_path}/in", [(2, "c"), (3, "d")])
    _, again = pair_group(spark, tmp_path)
    again.start()
    again.drain()
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "c"), (3, "d")]
    # Each message was written by one batch only.
    log = spark.read.parquet(f"{tmp_path}/table/log")
    number = {b.attempt: b.number for b in table.current_commit().batches}
    assert sorted((number[r["attempt"]], r["id"]) for r in log.collect()) == [(0, 1), (0, 2), (1, 2), (1, 3)]


def test_new_checkpoint_replaces_nothing(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "a"), (2, "b")])
    table, group = pair_group(spark, tmp_path)
    group.start()
    group.drain()
    build = lambda: parquet_stream(spark, f"{tmp_path}/other")
    write_pairs(spark, f"{tmp_path}/other", [(2, "c")])
    other = QueryGroup(
        spark, [Output(build, upsert_sink(table))], f"{tmp_path}/other_cp", available_now=True
    )
    other.start()
    other.drain()
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "c")]


def test_sink_writes_again_after_an_error(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "a")])
    calls, renewed = [], []
    table, group = pair_group(
        spark, tmp_path, retries=2, before_retry=lambda: renewed.append(1)
    )
    write = table.write_batch

    def unreliable(*args):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
        write(*args)

    table.write_batch = unreliable
    group.start()
    group.drain()
    assert len(calls) == 3 and len(renewed) == 2
    assert table.read().count() == 1


def test_exhausted_sink_fails_the_query_and_loses_nothing(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "a")])
    table, group = pair_group(spark, tmp_path, retries=1)

    def broken(*args):
        raise OSError("down")

    table.write_batch = broken
    group.start()
    with pytest.raises(Exception):
        group.drain()
    whole, again = pair_group(spark, tmp_path)
    again.start()
    again.drain()
    assert whole.read().count() == 1


def test_restarted_query_sees_new_static_rows(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "x")])
    write_pairs(spark, f"{tmp_path}/static", [(1, "one")])
    table = UpsertTable(spark, f"{tmp_path}/t", TableSpec("named", struct(id=INT, v=TEXT, name=TEXT), ("id",)))

    def build():
        static = spark.read.parquet(f"{tmp_path}/static")
        return enrich(parquet_stream(spark, f"{tmp_path}/in"), static, "id", {"name": "v"})

    group = QueryGroup(spark, [Output(build, upsert_sink(table))], f"{tmp_path}/cp")
    group.start()
    group.drain()
    write_pairs(spark, f"{tmp_path}/static", [(2, "two")])
    group.restart("named")
    write_pairs(spark, f"{tmp_path}/in", [(2, "y")])
    group.drain()
    group.stop()
    assert sorted((r["id"], r["name"]) for r in table.read().collect()) == [(1, "one"), (2, "two")]


def test_group_runs_for_a_time_and_restarts(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "x")])
    table = UpsertTable(spark, f"{tmp_path}/t", PAIRS)
    builds, steps = [], []

    def build():
        builds.append(1)
        if len(builds) == 3:
            raise RuntimeError("source is gone")
        return parquet_stream(spark, f"{tmp_path}/in")

    group = QueryGroup(
        spark,
        [Output(build, upsert_sink(table))],
        f"{tmp_path}/cp",
        before_start=[lambda: steps.append("clean"), lambda: steps.append("feed")],
    )
    group.start()
    started = time.monotonic()
    group.await_termination(6, {"pairs": 1.5})
    assert 5.5 < time.monotonic() - started < 30
    assert steps == ["clean", "feed"]
    # A restart that failed was logged; the next one was tried all the same.
    assert len(builds) >= 4
    group.drain()
    group.stop()
    assert table.read().count() == 1
    with pytest.raises(ValueError):
        group.await_termination(1, {"nope": 1})


def test_group_raises_the_error_of_a_query(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "x")])
    broken = lambda: parquet_stream(spark, f"{tmp_path}/in").withColumn(
        "v", F.raise_error(F.lit("bad row")).cast("string")
    )
    table = UpsertTable(spark, f"{tmp_path}/t", PAIRS)
    group = QueryGroup(spark, [Output(broken, upsert_sink(table))], f"{tmp_path}/cp")
    group.start()
    with pytest.raises(Exception, match="bad row"):
        group.await_termination(60)


def test_names_must_differ(spark, tmp_path):
    out = Output(lambda: None, memory_sink("same"))
    with pytest.raises(ValueError):
        QueryGroup(spark, [out, out], str(tmp_path))


def test_checkpoints_are_stable_and_apart():
    assert checkpoint_path("/a/b/", "x") == "/a/b/x"
    assert checkpoint_path("/a/b", "y") == "/a/b/y"


def test_csv_sink_writes_a_header(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "x"), (2, None)])
    out = Output(lambda: parquet_stream(spark, f"{tmp_path}/in"), csv_sink("pairs", f"{tmp_path}/out"))
    group = QueryGroup(spark, [out], f"{tmp_path}/cp", available_now=True)
    group.start()
    group.drain()
    files = list((tmp_path / "out" / "pairs.csv").glob("part-*.csv"))
    assert files and all(f.read_text().startswith("id,v") for f in files)


def test_messages_leave_null_fields_out(spark):
    rows = spark.createDataFrame(
        [("1", None, 3, None, samples.at("2018-11-12 09:42:00"), None, "Debit")], TRANSACTION
    )
    message = to_messages(rows, "customer_id").first()
    assert message["key"] is None
    assert message["value"] == (
        '{"transaction_id":"1","vendor_id":3,"event_timestamp":"2018-11-12 09:42:00","card_type":"Debit"}'
    )
    assert to_messages(rows, None).first()["key"] is None
    assert to_messages(rows, "vendor_id").first()["key"] == "3"


def test_times_keep_their_microseconds(spark, tmp_path):
    spark.sql("SELECT 1 AS id, TIMESTAMP'2018-11-12 09:42:00.123456' AS at").write.parquet(f"{tmp_path}/in")
    assert to_messages(spark.read.parquet(f"{tmp_path}/in"), None).first()["value"] == '{"id":1,"at":"2018-11-12 09:42:00.123456"}'
    sink = csv_sink("times", f"{tmp_path}/out", None)
    group = QueryGroup(spark, [Output(lambda: spark.readStream.schema("id int, at timestamp").parquet(f"{tmp_path}/in"), sink)], f"{tmp_path}/cp", available_now=True)
    group.start()
    group.drain()
    back = spark.read.schema("id int, at timestamp").csv(f"{tmp_path}/out/times.csv", header=True)
    assert str(back.selectExpr("CAST(at AS STRING) AS at").first().at) == "2018-11-12 09:42:00.123456"


def test_undecided_records_have_a_table(spark, tmp_path):
    from brooklet.plans.deploy import deployed_full

    group = deployed_full(spark, {}.get, f"{tmp_path}/tables", f"{tmp_path}/cp")
    assert "undecided_transactions" in group.queries and "undecided_transactions" in TABLES


def test_messages_go_round_through_files(spark, tmp_path):
    rows = [
        ("1", 1, 3, "SWIPED", samples.at("2018-11-12 09:42:00"), "5", "Debit"),
        ("2", None, 3, "SWIPED", samples.at("2018-11-12 09:42:01"), None, "Debit"),
    ]
    spark.createDataFrame(rows, TRANSACTION).write.parquet(f"{tmp_path}/in")
    sink = message_sink("messages", "customer_id", f"{tmp_path}/out")
    out = Output(lambda: parquet_stream(spark, f"{tmp_path}/in"), sink)
    group = QueryGroup(spark, [out], f"{tmp_path}/cp", available_now=True)
    group.start()
    group.drain()
    lines = spark.read.schema("key string, value string").json(f"{tmp_path}/out")
    assert sorted((r["key"] for r in lines.collect()), key=str) == ["1", None]
    back = parse_json(lines, TRANSACTION)
    assert sorted(tuple(r) for r in back.collect()) == rows
    assert [r["transaction_id"] for r in routed(back)["valid"].collect()] == ["1"]


def test_message_files_are_read_back_with_their_keys(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "a"), (2, "b")])
    sinks = {"keyed": message_sink("keyed", "id", f"{tmp_path}/keyed"), "plain": message_sink("plain", "id", f"{tmp_path}/plain", values_only=True)}
    group = QueryGroup(spark, [Output(lambda: parquet_stream(spark, f"{tmp_path}/in"), s) for s in sinks.values()], f"{tmp_path}/cp", available_now=True)
    group.start()
    group.drain()
    build = lambda: parse_json(message_dir_stream(spark, f"{tmp_path}/keyed", 1), PAIR, raw="text").withColumn("v", F.upper("v"))
    again = QueryGroup(spark, [Output(build, memory_sink("read_back"))], f"{tmp_path}/cp2", available_now=True)
    again.start()
    again.drain()
    assert sorted((r["id"], r["v"]) for r in spark.table("read_back").collect()) == [(1, "A"), (2, "B")]
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/plain").collect()) == ['{"id":1,"v":"a"}', '{"id":2,"v":"b"}']


def test_a_customer_that_arrives_between_two_batches_is_no_orphan(spark, tmp_path):
    known = UpsertTable(spark, f"{tmp_path}/known", PAIRS)
    known.load(spark.createDataFrame([(1, "x")], PAIR))
    found = UpsertTable(spark, f"{tmp_path}/found", replace(PAIRS, keep=KEEP_FIRST))

    def missing(batch, moment):
        side = moment.tables["known"]
        return batch.join(side, "id", "left_anti").withColumn("v", F.lit(moment.clock).cast("string"))

    sink = upsert_sink(found, "missing", join=missing, live={"known": known}, clock=lambda n: samples.at(f"2022-01-01 00:00:0{n}"))
    write_pairs(spark, f"{tmp_path}/in", [(1, "a"), (2, "a"), (3, "a")])
    query = sink.writer(parquet_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/cp").start()
    query.processAllAvailable()
    known.load(spark.createDataFrame([(4, "y")], PAIR))
    write_pairs(spark, f"{tmp_path}/in", [(2, "b"), (4, "b"), (5, "b")])
    query.processAllAvailable()
    query.stop()
    got = {r["id"]: r["v"] for r in found.read().collect()}
    # The second is an orphan since the first batch and keeps that time; the fourth never was one.
    assert got == {2: "2022-01-01 00:00:00", 3: "2022-01-01 00:00:00", 5: "2022-01-01 00:00:01"}
    with pytest.raises(ValueError):
        upsert_sink(found, live={"known": known})


def test_a_sink_folds_its_table_now_and_then(spark, tmp_path):
    for n in range(5):
        write_pairs(spark, f"{tmp_path}/in", [(n, "a"), (0, f"v{n}")])
    table = UpsertTable(spark, f"{tmp_path}/t", PAIRS)
    sink = upsert_sink(table, maintenance=Maintenance(compact_every=2, merge_every=2, keep_versions=1))
    group = QueryGroup(spark, [Output(lambda: parquet_stream(spark, f"{tmp_path}/in", 1), sink)], f"{tmp_path}/cp", available_now=True)
    group.start()
    group.drain()
    commit = table.current_commit()
    assert len(commit.layers) == 1 and len(commit.batches) == 2
    assert table.read().count() == 5 and table.obsolete() == []


def test_trigger_is_honoured(spark, tmp_path):
    write_pairs(spark, f"{tmp_path}/in", [(1, "x")])
    table = UpsertTable(spark, f"{tmp_path}/t", PAIRS)
    sink = upsert_sink(table, trigger_seconds=0.5)
    query = sink.writer(parquet_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/cp").start()
    query.processAllAvailable()
    query.stop()
    assert table.read().count() == 1


def test_spec_of_every_stored_table():
    assert set(TABLES) >= {"customers", "vendors", "valid_transactions", "transactions"}
    assert isinstance(memory_sink("x"), Sink)
