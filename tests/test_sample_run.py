"""The sample run through the flows, as static frames and as streams of one file per batch."""

import pytest
from pyspark.sql import functions as F

import samples
from brooklet.plans.card import (
    Sources,
    full_application,
    simple_application,
    table_sinks,
    transactions_flow,
    customers_flow,
    vendors_flow,
)
from brooklet.schemas import (
    CUSTOMER,
    STATE,
    TABLES,
    TRANSACTION,
    TRANSACTION_COLUMNS,
    VENDOR,
)
from brooklet.sources.files import json_dir_stream, json_file
from brooklet.streaming.group import Output, QueryGroup
from brooklet.streaming.sinks import create_sink, csv_sink, memory_sink, upsert_sink
from brooklet.streaming.upsert import UpsertTable


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    files = [[samples.transaction_line(r) for r in rows] for rows in samples.TRANSACTION_FILES]
    samples.write_in_order(base / "stream" / "transactions", files)
    samples.write_in_order(base / "stream" / "customers", [samples.CUSTOMER_LINES])
    samples.write_in_order(base / "stream" / "vendors", [samples.VENDOR_LINES])
    samples.write_lines(base / "static" / "customers" / "c.json", samples.STATIC_CUSTOMER_LINES)
    samples.write_lines(base / "static" / "vendors" / "v.json", samples.VENDOR_LINES)
    samples.write_lines(base / "static" / "states" / "s.json", samples.STATE_LINES)
    return base


@pytest.fixture(scope="module")
def sources(spark, inputs):
    return Sources(
        states=json_file(spark, f"{inputs}/static/states"),
        customers=json_file(spark, f"{inputs}/static/customers"),
        vendors=json_file(spark, f"{inputs}/static/vendors"),
        customer_stream=json_dir_stream(spark, f"{inputs}/stream/customers", "update_timestamp", 1),
        vendor_stream=json_dir_stream(spark, f"{inputs}/stream/vendors", "update_timestamp", 1),
        transaction_stream=json_dir_stream(
            spark, f"{inputs}/stream/transactions", "event_timestamp", 1
        ),
    )


def windows(df):
    return {str(r["start_ts"]): r["num_transactions"] for r in df.collect()}


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


def test_static_run(spark, inputs, sources):
    rows = spark.read.schema(TRANSACTION).json(f"{inputs}/stream/transactions")
    rows = rows.withColumn("timestamp", F.col("event_timestamp"))
    flow = transactions_flow(rows, sources.customers(CUSTOMER), sources.vendors(VENDOR))
    assert ids(flow["valid_transactions"]) == samples.VALID_IDS
    assert ids(flow["invalid_transactions"]) == samples.INVALID_IDS
    assert flow["undecided_transactions"].count() == 0
    assert flow["valid_transactions"].columns == TRANSACTION_COLUMNS
    assert windows(flow["transactions_operational_metadata"]) == samples.WINDOWS
    assert [tuple(r)[:4] for r in flow["customer_orphans"].collect()] == [
        (samples.UNKNOWN_CUSTOMER, "Unknown", "Unknown", -1)
    ]
    assert [tuple(r)[:3] for r in flow["vendor_orphans"].collect()] == [(samples.UNKNOWN_VENDOR, "Unknown", "Unknown")]


def test_static_customers_and_vendors(spark, inputs, sources):
    named = customers_flow(
        json_file(spark, f"{inputs}/stream/customers")(CUSTOMER), sources.states(STATE)
    )
    assert sorted(tuple(r)[:5] for r in named.collect()) == [
        (k, first, last, samples.STATES[state][0], short)
        for k, (first, last, state, short) in samples.CUSTOMERS.items()
    ]
    assert {str(r["update_timestamp"]) for r in named.collect()} == {f"{samples.DAY} 00:00:00"}
    assert vendors_flow(sources.vendors(VENDOR)).count() == len(samples.VENDORS)


def test_state_without_name_stays(spark):
    rows = spark.createDataFrame([(1, 77, "A", "B", samples.at("2021-01-01 00:00:00"))], CUSTOMER)
    states = spark.createDataFrame([(1, "Alabama", "AL")], STATE)
    assert [r["state_name"] for r in customers_flow(rows, states).collect()] == [None]


def test_full_application(spark, sources, tmp_path):
    group = full_application(
        spark,
        sources,
        table_sinks(spark, f"{tmp_path}/tables"),
        f"{tmp_path}/checkpoints",
        available_now=True,
    )
    assert list(group.queries) == [
        "invalid_transactions",
        "valid_transactions",
        "customer_orphans",
        "vendor_orphans",
        "customers",
        "vendors",
        "transactions_operational_metadata",
    ]
    group.start()
    group.drain()
    read = {n: UpsertTable(spark, f"{tmp_path}/tables/{n}", TABLES[n]).read() for n in group.queries}
    assert ids(read["valid_transactions"]) == samples.VALID_IDS
    assert ids(read["invalid_transactions"]) == samples.INVALID_IDS
    assert [r["customer_id"] for r in read["customer_orphans"].collect()] == [samples.UNKNOWN_CUSTOMER]
    assert [r["vendor_id"] for r in read["vendor_orphans"].collect()] == [samples.UNKNOWN_VENDOR]
    assert windows(read["transactions_operational_metadata"]) == samples.WINDOWS
    assert sorted(r["state_abbreviation"] for r in read["customers"].collect()) == sorted(x[3] for x in samples.CUSTOMERS.values())
    assert read["vendors"].count() == len(samples.VENDORS)


def test_shared_pass_equals_single_queries(spark, sources, tmp_path):
    names = ["valid_transactions", "invalid_transactions", "customer_orphans", "vendor_orphans"]
    tables = {n: UpsertTable(spark, f"{tmp_path}/{n}", TABLES[n]) for n in names}
    group = full_application(
        spark, sources, {}, f"{tmp_path}/cp", available_now=True, shared_pass=tables
    )
    group.start()
    group.drain()
    assert ids(tables["valid_transactions"].read()) == samples.VALID_IDS
    assert ids(tables["invalid_transactions"].read()) == samples.INVALID_IDS
    assert [r["customer_id"] for r in tables["customer_orphans"].read().collect()] == [samples.UNKNOWN_CUSTOMER]
    assert [r["vendor_id"] for r in tables["vendor_orphans"].read().collect()] == [samples.UNKNOWN_VENDOR]


def test_shared_pass_takes_no_counts(spark, sources, tmp_path):
    name = "transactions_operational_metadata"
    with pytest.raises(ValueError):
        full_application(
            spark, sources, {}, "cp", shared_pass={name: UpsertTable(spark, str(tmp_path), TABLES[name])}
        )


def run(spark, name, build, sink, checkpoint):
    group = QueryGroup(spark, [Output(build, sink)], checkpoint, available_now=True)
    group.start()
    group.drain()


def counts(sources, dedup="batch"):
    from brooklet.plans.card import transaction_output

    return transaction_output(
        "transactions_operational_metadata", sources.transaction_stream(TRANSACTION), sources
    )


def test_update_mode_emits_running_counts(spark, sources, tmp_path):
    run(spark, "w", lambda: counts(sources), memory_sink("running_counts", "update"), str(tmp_path))
    emitted = spark.table("running_counts").where(F.col("start_ts") == samples.BUSY_MINUTE)
    assert sorted(r["num_transactions"] for r in emitted.collect()) == samples.BUSY_COUNTS


def test_append_mode_holds_the_last_window_back(spark, sources, tmp_path):
    run(spark, "w", lambda: counts(sources), csv_sink("windows", f"{tmp_path}/out", None), f"{tmp_path}/cp")
    schema = TABLES["transactions_operational_metadata"].schema
    closed = spark.read.schema(schema).csv(f"{tmp_path}/out/windows.csv", header=True)
    expected = dict(samples.WINDOWS)
    del expected[samples.LAST_MINUTE]
    assert windows(closed) == expected


@pytest.mark.parametrize("dedup", ["batch", "global"])
def test_orphans_on_a_stream(spark, sources, tmp_path, dedup):
    from brooklet.plans.card import transaction_output

    def build():
        stream = sources.transaction_stream(TRANSACTION)
        return transaction_output("customer_orphans", stream, sources, dedup)

    run(spark, "o", build, memory_sink(f"orphans_{dedup}"), str(tmp_path))
    assert [r["customer_id"] for r in spark.table(f"orphans_{dedup}").collect()] == [samples.UNKNOWN_CUSTOMER]


def test_simple_application(spark, sources, tmp_path):
    transactions = UpsertTable(spark, f"{tmp_path}/t", TABLES["transactions"])
    metadata = UpsertTable(spark, f"{tmp_path}/m", TABLES["operational_metadata"])
    group = simple_application(
        spark,
        sources.customers,
        lambda schema: sources.transaction_stream(schema).drop("timestamp"),
        {"transactions": upsert_sink(transactions), "operational_metadata": upsert_sink(metadata)},
        f"{tmp_path}/cp",
        available_now=True,
    )
    group.start()
    group.drain()
    rows = {(r["transaction_id"], r["customer_id"]): r for r in transactions.read().collect()}
    assert len(rows) == len({r[:2] for r in samples.ALL_ROWS})
    assert rows[("sale-00", 21)]["customer_first_name"] == "Noor"
    assert rows[("sale-09", samples.UNKNOWN_CUSTOMER)]["customer_first_name"] is None
    assert {r["is_valid"] for r in rows.values()} == {False}
    assert windows(metadata.read()) == samples.WINDOWS


def test_create_sink_rejects_other_modes(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), TABLES["vendors"])
    assert create_sink("upsert", "update", table).name == "vendors"
    for mode in ("append", "complete"):
        with pytest.raises(ValueError):
            create_sink("upsert", mode, table)
    with pytest.raises(ValueError):
        create_sink("csv", "update", "x", "y")
    with pytest.raises(ValueError):
        create_sink("nowhere", "update")
