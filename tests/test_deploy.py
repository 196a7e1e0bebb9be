"""The applications between topics and tables, with files of messages as topics."""

import samples
from brooklet.plans.deploy import deployed_full, deployed_simple, main, seed_states
from brooklet.schemas import CUSTOMER, MESSAGE, STATES, STORED_CUSTOMER, TABLES, VENDOR
from brooklet.sources.files import parquet_stream
from brooklet.sources.messages import parse_json
from brooklet.sources.tables import table_source
from brooklet.streaming.group import Output, QueryGroup
from brooklet.streaming.sinks import upsert_sink
from brooklet.streaming.upsert import UpsertTable

ARRIVED = samples.at("2021-03-01 10:00:00")


def publish(spark, base, topic, lines):
    rows = [(b"k", line.encode(), topic, 0, i, ARRIVED) for i, line in enumerate(lines)]
    spark.createDataFrame(rows, MESSAGE).write.mode("append").parquet(f"{base}/{topic}")


def topics_below(spark, base):
    return lambda topic: parquet_stream(spark, f"{base}/{topic}")


def seed(spark, base):
    seed_states(spark, base)
    rows = [(k, *names[:2], "Iowa", "IA", None) for k, names in samples.CUSTOMERS.items()]
    customers = UpsertTable(spark, f"{base}/customers", TABLES["customers"])
    customers.load(spark.createDataFrame(rows, STORED_CUSTOMER))
    vendors = UpsertTable(spark, f"{base}/vendors", TABLES["vendors"])
    vendors.load(spark.createDataFrame([(k, *v, None) for k, v in samples.VENDORS.items()], VENDOR))


def publish_samples(spark, base):
    lines = [samples.transaction_line(r) for rows in samples.TRANSACTION_FILES for r in rows]
    publish(spark, base, "transaction", [*lines, '{"transaction_id":'])
    publish(spark, base, "customer", samples.CUSTOMER_LINES)
    publish(spark, base, "vendor", samples.VENDOR_LINES)


def test_full(spark, tmp_path):
    tables, log = f"{tmp_path}/tables", f"{tmp_path}/log"
    seed(spark, tables)
    publish_samples(spark, log)
    # A customer whom the stream does not bring.
    extra = spark.createDataFrame([(9, "Ann", "Lee", "Iowa", "IA", None)], STORED_CUSTOMER)
    UpsertTable(spark, f"{tables}/customers", TABLES["customers"]).load(extra)
    group = deployed_full(spark, topics_below(spark, log), tables, f"{tmp_path}/cp", True)
    group.start()
    group.drain()
    read = {n: UpsertTable(spark, f"{tables}/{n}", TABLES[n]) for n in TABLES}
    valid = read["valid_transactions"].read().collect()
    assert sorted(r["transaction_id"] for r in valid) == samples.VALID_IDS
    assert sorted(r["transaction_id"] for r in read["invalid_transactions"].read().collect()) == samples.INVALID_IDS
    assert read["invalid_transactions"].rejects().count() == 1
    (broken,) = UpsertTable(spark, f"{tables}/malformed_messages", TABLES["malformed_messages"]).read().collect()
    assert (broken["topic"], bytes(broken["value"])) == ("transaction", b'{"transaction_id":')
    assert read["customer_orphans"].read().first()["customer_id"] == samples.UNKNOWN_CUSTOMER
    assert read["vendor_orphans"].read().first()["vendor_id"] == samples.UNKNOWN_VENDOR
    counts = read["transactions_operational_metadata"].read().collect()
    assert {str(r["start_ts"]): r["num_transactions"] for r in counts} == samples.WINDOWS
    customers = {r["customer_id"]: r["state_abbreviation"] for r in read["customers"].read().collect()}
    short = {state: text for state, _, text in STATES}
    assert customers == {9: "IA", **{k: short[v[2]] for k, v in samples.CUSTOMERS.items()}}


def test_simple(spark, tmp_path):
    tables, log = f"{tmp_path}/tables", f"{tmp_path}/log"
    seed(spark, tables)
    publish_samples(spark, log)
    group = deployed_simple(spark, topics_below(spark, log), tables, f"{tmp_path}/cp", True)
    group.start()
    group.drain()
    transactions = UpsertTable(spark, f"{tables}/transactions", TABLES["transactions"])
    rows = transactions.read().collect()
    # One id comes twice at different times, so nothing collapses; the bad text is a reject.
    assert len(rows) == len(samples.ALL_ROWS) and transactions.rejects().count() == 1
    assert {r["customer_first_name"] for r in rows} == {None, *(names[0] for names in samples.CUSTOMERS.values())}


def test_catch_up_then_follow(spark, tmp_path):
    publish(spark, str(tmp_path), "vendor", samples.VENDOR_LINES[:1])
    table = UpsertTable(spark, f"{tmp_path}/t", TABLES["vendors"])
    build = lambda: parse_json(parquet_stream(spark, f"{tmp_path}/vendor"), VENDOR)
    group = QueryGroup(spark, [Output(build, upsert_sink(table))], f"{tmp_path}/cp")
    group.catch_up_and_start()
    assert table.read().count() == 1  # all that was there, before anything else is read
    publish(spark, str(tmp_path), "vendor", samples.VENDOR_LINES[1:])
    group.drain()
    group.stop()
    assert table.read().count() == len(samples.VENDORS)


def test_table_source_reads_anew_and_registers_a_view(spark, tmp_path):
    table = UpsertTable(spark, f"{tmp_path}/t", TABLES["vendors"])
    source = table_source(table, "known_vendors")
    assert source(CUSTOMER).count() == 0
    table.load(spark.createDataFrame([(31, "Lake Kiosk", "1", None)], VENDOR))
    assert source(CUSTOMER).columns == VENDOR.fieldNames()
    assert spark.table("known_vendors").count() == 1


def test_usage(capsys):
    assert main([]) == 2
    assert "client.properties" in capsys.readouterr().err
