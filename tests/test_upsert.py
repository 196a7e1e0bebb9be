"""The keyed table: replays, ties, rejects, folding, pruning, offloading; against a dictionary."""

import json
import random
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import samples
from brooklet.operators.latest import latest
from brooklet.schemas import FIRST, INT, LONG, TABLES, TEXT, TIME, TableSpec, struct
from brooklet.streaming.commits import Batch, CommitLog
from brooklet.streaming.files import children, claim, read_text
from brooklet.streaming.live import moment_of
from brooklet.streaming.upsert import UpsertTable, with_retries

SPEC = TableSpec("t", struct(id=INT, v=TEXT, n=LONG), ("id",), buckets=3, order_by=("n",))
DATED = TableSpec(
    "d",
    struct(ts=TIME, id=TEXT, v=INT),
    ("ts", "id"),
    hash_columns=("id",),
    buckets=3,
    range_column="ts",
)


def batch(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema)


def content(table, **how):
    return {r["id"]: (r["v"], r["n"]) for r in table.read(**how).collect()}


def test_later_batch_wins_whatever_its_values(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    assert table.read().count() == 0
    table.write_batch(batch(spark, [(1, "a", 9), (2, "b", 1)]), 0)
    table.write_batch(batch(spark, [(1, "c", 1)]), 1)
    assert content(table) == {1: ("c", 1), 2: ("b", 1)}


def test_ties_in_a_batch_fall_by_order_then_by_all_columns(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    rows = [(1, "a", 1), (1, "b", 2), (2, "x", 5), (2, "y", 5), (3, "z", None), (3, None, 0)]
    table.write_batch(batch(spark, rows), 0)
    assert content(table) == {1: ("b", 2), 2: ("y", 5), 3: (None, 0)}


def test_replay_changes_nothing(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    table.write_batch(batch(spark, [(1, "a", 1), (None, "r", 1)]), 0)
    before = content(table)
    table.write_batch(batch(spark, [(1, "a", 1), (None, "r", 1)]), 0)
    assert content(table) == before
    assert table.rejects().count() == 1


def test_replay_drops_what_a_broken_attempt_left(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        table = UpsertTable(spark, str(tmp_path), SPEC)
        table.write_batch(batch(spark, [(None, "r", 1)]), 0)
        table.write_batch(batch(spark, [(1, "a", 1)]), 0)
        assert table.rejects().count() == 0 and content(table) == {1: ("a", 1)}
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_rows_without_a_whole_key_are_rejects(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), DATED)
    when = samples.at("2018-11-13 09:45:00")
    rows = [(when, "a", 1), (None, "a", 2), (when, None, 3)]
    table.write_batch(spark.createDataFrame(rows, DATED.schema), 0)
    assert [r["v"] for r in table.read().collect()] == [1]
    assert sorted(r["v"] for r in table.rejects().collect()) == [2, 3]


def test_same_id_at_another_time_is_another_key(spark, tmp_path):
    spec = TABLES["valid_transactions"]
    table = UpsertTable(spark, str(tmp_path), spec)
    times = ["2018-11-13 09:43:01", "2018-11-13 09:44:01", "2018-11-13 09:45:05"]
    rows = [("13", 1, 1, "SWIPED", samples.at(t), "100", "Debit") for t in times]
    table.write_batch(spark.createDataFrame(rows, spec.schema), 0)
    table.write_batch(spark.createDataFrame(rows[:1], spec.schema), 1)
    assert table.read().count() == 3


def test_another_writer_begins_a_new_run(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    table.load(batch(spark, [(1, "seed", 1), (2, "seed", 1)]))
    table.write_batch(batch(spark, [(1, "a", 1)]), 5, "first")
    assert content(table) == {1: ("a", 1), 2: ("seed", 1)}
    # A query with a new checkpoint counts from 0 again and replaces nothing.
    table.write_batch(batch(spark, [(1, "b", 1)]), 0, "second")
    table.write_batch(batch(spark, [(3, "c", 1)]), 0, "second")
    assert content(table) == {1: ("a", 1), 2: ("seed", 1), 3: ("c", 1)}
    table.load(batch(spark, [(3, "d", 1)]))
    table.write_batch(batch(spark, [(2, "e", 1)]), 1, "second")
    assert content(table) == {1: ("a", 1), 2: ("e", 1), 3: ("d", 1)}
    table.compact()
    table.write_batch(batch(spark, [(2, "f", 1)]), 1, "second")
    table.compact(full=True, settled=True)
    assert content(table) == {1: ("a", 1), 2: ("f", 1), 3: ("d", 1)}


def test_empty_batches_keep_their_run(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    table.write_batch(batch(spark, []), 0, "w")
    table.write_batch(batch(spark, [(1, "a", 1)]), 1, "w")
    assert {b.run for b in table.current_commit().batches} == {0}
    table.load(batch(spark, []))
    table.write_batch(batch(spark, [(1, "b", 1)]), 2, "w")
    assert content(table) == {1: ("b", 1)}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_writes_folds_and_replays(spark, tmp_path, seed):
    rng = random.Random(seed)
    table, expected, number = UpsertTable(spark, str(tmp_path), SPEC), {}, 0
    for step in range(10):
        rows = {k: (k, f"v{step}", rng.randrange(9)) for k in rng.sample(range(12), 4)}
        table.write_batch(batch(spark, list(rows.values())), number)
        if rng.random() < 0.3:
            table.write_batch(batch(spark, list(rows.values())), number)
        expected |= {k: v[1:] for k, v in rows.items()}
        number += 1
        if rng.random() < 0.4:
            table.compact(full=rng.random() < 0.4)
            if rng.random() < 0.5:
                table.write_batch(batch(spark, list(rows.values())), number - 1)
    assert content(table) == expected
    table.compact(full=True, settled=True)
    assert content(table) == expected
    assert len(table.current_commit().layers) == 1 and not table.current_commit().batches


def test_compaction_leaves_the_newest_batch_in_the_log(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    assert table.compact().version == -1
    table.write_batch(batch(spark, [(1, "a", 1)]), 0)
    assert not table.compact().layers
    table.write_batch(batch(spark, [(1, "b", 1), (None, "r", 2)]), 1)
    commit = table.compact()
    assert len(commit.layers) == 1 and [b.position for b in commit.batches] == [(0, 1)]
    # The newest batch comes again with other rows, as after a change of a static table.
    table.write_batch(batch(spark, [(1, "c", 1), (None, "r", 2)]), 1)
    assert content(table) == {1: ("c", 1)}
    table.write_batch(batch(spark, [(2, "d", 1)]), 2)
    later = table.compact()
    assert len(later.layers) == 2 and later.layers[0] == commit.layers[0]
    assert content(table) == {1: ("c", 1), 2: ("d", 1)}
    full = table.compact(full=True)
    assert len(full.layers) == 1
    # What has been folded goes; rejects stay.
    assert table.clean_up(keep_versions=1)
    assert table.obsolete() == []
    assert content(table) == {1: ("c", 1), 2: ("d", 1)}
    assert [r["v"] for r in table.rejects().collect()] == ["r"]


def bucket_of(file):
    """Month and bucket of a file of a snapshot."""
    month, bucket = re.search(r"month=([^/]+)/key_bucket=(\d+)/", file).groups()
    return month, int(bucket)


def test_lookup_reads_one_bucket(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    table.write_batch(batch(spark, [(i, f"v{i}", i) for i in range(30)]), 0)
    table.compact(full=True, settled=True)
    table.write_batch(batch(spark, [(7, "new", 1)]), 1)
    assert content(table, keys={"id": 7}) == {7: ("new", 1)}
    assert content(table, keys={"id": 8}) == {8: ("v8", 8)}
    (piece,) = [p for p in table.current_commit().layers[0] if p.bucket == table._bucket_of({"id": 8})]
    files = table.read(keys={"id": 8}).inputFiles()
    assert {bucket_of(f) for f in files if "/snapshot/" in f} == {("all", piece.bucket)}
    with pytest.raises(ValueError):
        table.read(keys={"v": "a"})


def dated_rows(spark):
    rows = [
        (samples.at(f"2018-{month:02d}-03 00:00:00"), f"k{i}", month * 100 + i)
        for month in (10, 11, 12)
        for i in range(4)
    ]
    return spark.createDataFrame(rows, DATED.schema)


def test_months_are_pruned(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), DATED)
    table.load(dated_rows(spark))
    table.compact(full=True, settled=True)
    table.load(dated_rows(spark).where("id = 'k1'").withColumn("v", F.col("v") + 1000))
    got = {(r["ts"].month, r["id"]): r["v"] for r in table.read(months=["2018-11"]).collect()}
    assert got == {(11, "k0"): 1100, (11, "k1"): 2101, (11, "k2"): 1102, (11, "k3"): 1103}
    with pytest.raises(ValueError):
        UpsertTable(spark, str(tmp_path / "x"), SPEC).read(months=["2018-11"])


def test_offload_moves_old_months(spark, tmp_path):
    table = UpsertTable(spark, f"{tmp_path}/t", DATED)
    table.load(dated_rows(spark))
    before = table.compact(settled=True)
    table.offload("2018-11", f"{tmp_path}/old", settled=True)
    commit = table.offload("2018-12", f"{tmp_path}/old", settled=True)
    assert set(commit.layers[0]) < set(before.layers[0])  # nothing was rewritten
    assert table.read().count() == 4
    old = spark.read.parquet(f"{tmp_path}/old")
    assert {r["month"] for r in old.select("month").distinct().collect()} == {"2018-10", "2018-11"}
    assert old.count() == 8
    # A late row for an old month is in the table until the next offload.
    late = dated_rows(spark).where("id = 'k1' AND month(ts) = 10").withColumn("v", F.lit(5))
    table.load(late)
    assert table.read().count() == 5
    table.compact(settled=True)
    assert table.read().count() == 5
    table.offload("2018-12", f"{tmp_path}/old", settled=True)
    assert table.read().count() == 4
    newest = spark.read.parquet(f"{tmp_path}/old").orderBy(F.col("version").desc()).first()
    assert (newest["v"], newest["month"]) == (5, "2018-10")
    table.compact(full=True, settled=True)
    assert table.read().count() == 4
    with pytest.raises(ValueError):
        UpsertTable(spark, str(tmp_path / "x"), SPEC).offload("2018-11", f"{tmp_path}/y")


def test_a_read_after_ten_thousand_batches_looks_into_one_folder(spark, tmp_path, monkeypatch):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    rows = spark.range(10_000).selectExpr("CAST(id % 5000 AS INT) AS id", "concat('v', id) AS v", "id AS n", "0 AS run", "id AS batch_id", "concat('a', id) AS attempt", "false AS rejected")
    rows.write.partitionBy("rejected").parquet(f"{tmp_path}/log/folder=f")
    batches = tuple(Batch(0, i, "w", f"a{i}", "f", 1, 0) for i in range(10_000))
    table._log.change(lambda now: replace(now, batches=batches, folder="f", run=0, writer="w"))
    listed = []
    monkeypatch.setattr("brooklet.streaming.commits.children", lambda spark, path: listed.append(path) or children(spark, path))
    got = table.read()
    assert listed == [f"{tmp_path}/commits"]
    assert "InMemoryFileIndex(1 paths)" in got._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: r["n"] for r in got.collect()} == {i: 5000 + i for i in range(5000)}


def test_a_merge_leaves_other_months_and_buckets_alone(spark, tmp_path, monkeypatch):
    table = UpsertTable(spark, str(tmp_path), DATED)
    table.load(dated_rows(spark))
    before = table.compact(settled=True)
    table.load(dated_rows(spark).where("id = 'k1' AND month(ts) = 11").withColumn("v", F.lit(7)))
    read = []
    merged = UpsertTable._merged

    def watched(self, layers, batches, chosen=()):
        frame = merged(self, layers, batches, chosen)
        read.extend(f for f in frame.inputFiles() if "/snapshot/" in f)
        return frame

    monkeypatch.setattr(UpsertTable, "_merged", watched)
    after = table.compact(full=True, settled=True)
    monkeypatch.undo()
    (touched,) = {p.place for p in after.layers[0]} & {bucket_of(f) for f in read}
    assert {bucket_of(f) for f in read} == {touched} and touched[0] == "2018-11"
    assert {p for p in before.layers[0] if p.place != touched} == {p for p in after.layers[0] if p.place != touched}
    assert table.read().count() == 12 and table.read(months=["2018-11"]).where("v = 7").count() == 1


def test_a_day_reads_one_month(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), DATED)
    table.load(dated_rows(spark))
    table.compact(settled=True)
    table.load(dated_rows(spark).where("month(ts) = 12").withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS")))
    day = samples.at("2018-11-03 00:00:00"), samples.at("2018-11-03 23:59:59")
    got = table.read(between=day)
    assert {bucket_of(f)[0] for f in got.inputFiles() if "/snapshot/" in f} == {"2018-11"}
    assert not [f for f in got.inputFiles() if "/log/" in f]
    assert sorted(r["v"] for r in got.collect()) == [1100, 1101, 1102, 1103]
    late = table.read(between=(samples.at("2018-12-04 00:00:00"), None))
    assert late.count() == 4 and not [f for f in late.inputFiles() if "/snapshot/" in f]
    assert table.read(between=(None, None)).count() == 16
    assert table.read(between=(samples.at("2030-01-01 00:00:00"), None)).count() == 0
    with pytest.raises(ValueError):
        UpsertTable(spark, str(tmp_path / "x"), SPEC).read(between=day)


def test_first_sighting_stays(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), replace(SPEC, keep=FIRST))
    table.write_batch(batch(spark, [(1, "a", 5), (1, "b", 3), (2, "a", 1)]), 0)
    table.write_batch(batch(spark, [(1, "c", 0), (3, "c", 9)]), 1)
    expected = {1: ("b", 3), 2: ("a", 1), 3: ("c", 9)}
    assert content(table) == expected
    table.compact()
    assert content(table) == expected
    table.write_batch(batch(spark, [(2, "d", 0), (3, "d", 0), (4, "d", 0)]), 2)
    expected[4] = ("d", 0)
    assert content(table) == expected
    table.compact()
    table.write_batch(batch(spark, [(4, "e", 0), (5, "e", 0)]), 3)
    expected[5] = ("e", 0)
    assert content(table) == expected
    table.compact(full=True, settled=True)
    assert content(table) == expected
    with pytest.raises(ValueError):
        replace(SPEC, keep="any")


def test_an_attempt_that_was_not_committed_counts_for_nothing(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    folder = table.write_batch(batch(spark, [(1, "a", 1)]), 0).folder
    lost = batch(spark, [(1, "lost", 9), (2, "lost", 9)]).withColumns({"attempt": F.lit("x"), "rejected": F.lit(False)})
    lost.write.mode("append").partitionBy("rejected").parquet(f"{tmp_path}/log/folder={folder}")
    assert content(table) == {1: ("a", 1)}
    table.compact(full=True, settled=True)
    assert content(table) == {1: ("a", 1)}


def test_earlier_versions_and_counts(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    first = table.write_batch(batch(spark, [(1, "a", 1), (None, "r", 1)]), 0)
    second = table.write_batch(batch(spark, [(1, "b", 1), (2, "b", 1)]), 1)
    assert content(table, version=first.version) == {1: ("a", 1)}
    assert content(table, version=-1) == {}
    assert (second.written, second.rejected) == (4, 1)
    again = table.write_batch(batch(spark, [(1, "b", 1)]), 1)
    assert (again.written, again.rejected) == (3, 1)
    assert table.num_rows() is None
    table.compact(full=True, settled=True)
    assert table.num_rows() == 1 == table.read().count()
    table.write_batch(batch(spark, []), 2)
    assert table.num_rows() == 1


def test_one_of_many_claims_wins(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: claim(spark, f"{tmp_path}/x/one.json", str(i)), range(40)))
    assert won.count(True) == 1
    assert read_text(spark, f"{tmp_path}/x/one.json") == str(won.index(True))
    assert children(spark, f"{tmp_path}/x") == ["one.json"]
    assert children(spark, f"{tmp_path}/y") is None


def test_changes_at_once_all_count(spark, tmp_path):
    def add(i):
        log = CommitLog(spark, f"{tmp_path}/commits")
        for _ in range(5):
            log.change(lambda now: replace(now, written=now.written + 1))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(add, range(6)))
    last = CommitLog(spark, f"{tmp_path}/commits").current()
    assert (last.written, last.version) == (30, 29)


def test_a_batch_that_is_tried_again_sees_the_version_it_saw(spark, tmp_path):
    table = UpsertTable(spark, f"{tmp_path}/t", SPEC)
    table.write_batch(batch(spark, [(1, "a", 1)]), 0)
    first = samples.at("2022-01-01 00:00:00")

    def seen(n, clock=lambda i: first):
        moment = moment_of(spark, f"{tmp_path}/cp", n, {"side": table}, clock)
        return moment.tables["side"].count(), moment.clock

    assert seen(0) == (1, first)
    table.write_batch(batch(spark, [(2, "b", 1)]), 1)
    assert seen(0, lambda i: samples.at("2030-01-01 00:00:00")) == (1, first)
    assert seen(1, None)[0] == 2
    assert json.loads(read_text(spark, f"{tmp_path}/cp/live/{1:012d}.json"))["versions"] == {"side": 1}


def test_view(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), SPEC)
    table.load(batch(spark, [(1, "a", 1)]))
    table.register_view("keyed")
    assert spark.sql("SELECT v FROM keyed").first()["v"] == "a"


def test_spec_checks():
    with pytest.raises(ValueError):
        TableSpec("x", SPEC.schema, ())
    with pytest.raises(ValueError):
        TableSpec("x", SPEC.schema, ("nope",))
    with pytest.raises(ValueError):
        TableSpec("x", SPEC.schema, ("id",), hash_columns=("v",))
    with pytest.raises(ValueError):
        TableSpec("x", SPEC.schema, ("id",), range_column="n")


@pytest.mark.parametrize(
    ("failures", "retries", "fails"), [(1, 1, False), (2, 1, True), (3, 3, False), (3, 4, False)]
)
def test_retries(failures, retries, fails):
    calls, renewed = [], []

    def write():
        calls.append(1)
        if len(calls) <= failures:
            raise OSError("down")

    if fails:
        with pytest.raises(OSError):
            with_retries(write, retries, lambda: renewed.append(1))
        assert len(calls) == retries + 1 and len(renewed) == retries
    else:
        with_retries(write, retries, lambda: renewed.append(1))
        assert len(calls) == failures + 1 and len(renewed) == failures


def test_negative_retries():
    with pytest.raises(ValueError):
        with_retries(lambda: None, -1)


def test_latest_against_brute_force(spark):
    rng = random.Random(5)
    # One key holds a third of the rows.
    rows = [
        (rng.choice([0] * 10 + list(range(20))), rng.choice([None, 1, 2, 3]), rng.choice("abc"))
        for _ in range(2000)
    ]
    expected = {}
    for k, o, v in rows:
        rank = ((o is not None, o or 0), v)
        if k not in expected or rank > expected[k][0]:
            expected[k] = (rank, (k, o, v))
    df = spark.createDataFrame(rows, "k int, o int, v string").repartition(4)
    got = sorted(tuple(r) for r in latest(df, ["k"], ["o"]).collect())
    assert got == sorted(v for _, v in expected.values())
