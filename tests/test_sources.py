"""Messages, files and options."""

import pytest
from pyspark.sql import functions as F

import samples
from brooklet.functions.text import has_keyword, nth_field
from brooklet.schemas import CUSTOMER, MESSAGE, TABLES, TRANSACTION
from brooklet.session import run_dir, shared_dir
from brooklet.sources.files import json_file, parquet_stream
from brooklet.sources.messages import (
    BROKER_TIME,
    broker_properties,
    field_records,
    json_source,
    kafka_options,
    message_backlog,
    message_stream,
    parse_csv,
    parse_json,
    parse_sightings,
    parse_text,
    properties_file,
    read_properties,
    text_records,
    with_prefix,
)
from brooklet.streaming.upsert import UpsertTable

ARRIVED = samples.at("2018-11-13 10:00:00")


def messages(spark, values, key=b"k"):
    rows = [(key, None if v is None else v.encode(), "t", 0, i, ARRIVED) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE)


def test_event_time_of_the_broker_and_of_the_message(spark):
    line = samples.transaction_line(samples.TRANSACTION_FILES[0][0])
    log = messages(spark, [line])
    assert parse_json(log, TRANSACTION, BROKER_TIME).first()["timestamp"] == ARRIVED
    own = parse_json(log, TRANSACTION, "event_timestamp").first()
    assert own["timestamp"] == own["event_timestamp"] == samples.at(samples.TRANSACTION_FILES[0][0][4])
    plain = parse_json(log, TRANSACTION)
    assert plain.columns == TRANSACTION.fieldNames()


@pytest.mark.parametrize(
    ("text", "column", "expected"),
    [
        ('{"transaction_id":', "transaction_id", None),
        ('{"transaction_id":"a","customer_id":"abc"}', "customer_id", None),
        ('{"transaction_id":"a","customer_id":"7"}', "customer_id", None),
        ('{"transaction_id":"a","customer_id":7}', "customer_id", 7),
        ('{"price":100}', "price", "100"),
        ('{"event_timestamp":"nope"}', "event_timestamp", None),
        ('{"transaction_id":"a"},', "transaction_id", "a"),
        (None, "transaction_id", None),
    ],
)
def test_lenient_parsing(spark, text, column, expected):
    rows = parse_json(messages(spark, [text]), TRANSACTION, raw="raw").collect()
    assert [r[column] for r in rows] == [expected]
    assert rows[0]["raw"] == text


def test_malformed_text_is_invalid_and_a_reject(spark, tmp_path):
    from brooklet.plans.card import routed

    rows = parse_json(messages(spark, ['{"transaction_id":']), TRANSACTION)
    invalid = routed(rows)["invalid"]
    assert invalid.count() == 1
    table = UpsertTable(spark, str(tmp_path), TABLES["invalid_transactions"])
    table.write_batch(invalid, 0)
    assert table.read().count() == 0 and table.rejects().count() == 1


def test_source_registers_a_view_and_opens_anew(spark):
    opened = []

    def log():
        opened.append(1)
        return messages(spark, ['{"customer_id": 3}'])

    source = json_source(log, view="transaction")
    source(TRANSACTION)
    assert spark.table("transaction").first()["customer_id"] == 3
    source(TRANSACTION)
    assert len(opened) == 2


def test_text_and_records(spark):
    log = messages(spark, ["a,b", "c"])
    assert [r["value"] for r in parse_text(log).collect()] == ["a,b", "c"]
    assert [tuple(r) for r in text_records(log).collect()] == [(0, "k", "a,b"), (1, "k", "c")]


def test_csv_fields_fail_one_by_one(spark):
    log = messages(spark, ["1542102000000,47.5,19.0", "x,47.5,19.0", "1542102000000,47.5", ""])
    got = [tuple(r)[1:] for r in parse_sightings(log).collect()]
    when = samples.at("2018-11-13 09:40:00")
    assert got == [(when, 47.5, 19.0), (None, 47.5, 19.0), (when, 47.5, None), (None, None, None)]
    assert parse_csv(log, "a string, b string", ("offset",)).columns == ["offset", "a", "b"]


def test_nth_field(spark):
    log = messages(spark, ["a,b,c,d,e,f", "a,b,c,d", ",,,,", "a.b"])
    assert [r["field"] for r in field_records(log, 5).collect()] == ["e", None, "", None]
    assert field_records(log, 2, ".").collect()[3]["field"] == "b"
    assert spark.range(1).select(nth_field(F.lit("x|y"), 2, "|").alias("v")).first()["v"] == "y"


def test_keywords(spark):
    rows = spark.createDataFrame([("My KETTLE broke",), ("a lamp",), (None,)], "t string")
    assert [r[0] for r in rows.select(has_keyword("t", ["toaster", "Kettle"])).collect()] == [True, False, None]
    with pytest.raises(ValueError):
        has_keyword("t", [])


def test_options(tmp_path):
    text = "# comment\n! other\nbootstrap.servers=a:1,b:2\nsasl.mechanism : PLAIN\nempty=\ngroup id\nlong=a,\\\n   b\n"
    (tmp_path / "client.properties").write_text(text)
    properties = properties_file(str(tmp_path / "client.properties"))
    assert properties == {
        "bootstrap.servers": "a:1,b:2",
        "sasl.mechanism": "PLAIN",
        "empty": "",
        "group": "id",
        "long": "a,b",
    }
    assert kafka_options(broker_properties("h:9"), "t", "earliest") == {
        "kafka.bootstrap.servers": "h:9",
        "kafka.security.protocol": "PLAINTEXT",
        "subscribe": "t",
        "startingOffsets": "earliest",
    }
    assert kafka_options({}, "t")["startingOffsets"] == "latest"
    assert with_prefix({"a.b": "1", "a.c": "2", "d": "3"}, "a.") == {"b": "1", "c": "2"}
    assert read_properties("") == {}


def test_connector_is_asked_for_by_name(spark):
    for read in (message_stream, message_backlog):
        with pytest.raises(Exception, match="(?i)kafka"):
            read(spark, broker_properties("localhost:1"), "t")


def test_static_json_skips_blank_lines(spark, tmp_path):
    samples.write_lines(tmp_path / "c.json", [*samples.STATIC_CUSTOMER_LINES, "", "  "])
    rows = json_file(spark, str(tmp_path), view="static_customers")(CUSTOMER).collect()
    assert [(r["customer_id"], r["state_id"]) for r in rows] == [(k, None) for k in samples.CUSTOMERS]
    assert spark.table("static_customers").count() == len(samples.CUSTOMERS)


def test_parquet_stream_of_a_file_and_of_a_directory(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/dir.parquet")
    part = next((tmp_path / "dir.parquet").glob("part-*.parquet"))
    for path in (f"{tmp_path}/dir.parquet", str(part)):
        name = f"seen_{abs(hash(path))}"
        query = (
            parquet_stream(spark, path)
            .writeStream.format("memory")
            .queryName(name)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        assert spark.table(name).count() == 5


def test_run_dirs_are_fresh_and_shared(spark):
    assert run_dir(spark, "a") != run_dir(spark, "a")
    assert run_dir(spark, "a").startswith(shared_dir(spark))


def test_no_shared_dir_on_a_cluster_is_an_error():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        shared_dir(Session())
    Context.master = "local[2]"
    assert shared_dir(Session()) == shared_dir(Session())
