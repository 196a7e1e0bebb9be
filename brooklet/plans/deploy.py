"""The applications between topics and keyed tables, as jobs to submit.

Arguments, after the options of ``spark-submit`` and the file ``submit.py``::

    full   client.properties <table folder> <checkpoint folder> [option=value ...]
    simple client.properties <table folder> <checkpoint folder> [option=value ...]

Options: ``seconds=600`` ends the job then; ``restart.<query>=60`` starts a query anew every so many
seconds; ``reader.<option>=<value>`` goes to the reader of the topics as it is, for instance
``reader.maxOffsetsPerTrigger=100000`` or ``reader.startingOffsets=earliest``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CUSTOMER, STATE, STATES, TABLES, TRANSACTION, VENDOR
from ..sources.messages import BROKER_TIME, json_source, malformed, message_stream, properties_file, with_prefix
from ..sources.tables import table_source
from ..streaming.group import Output, QueryGroup
from ..streaming.sinks import Maintenance, upsert_sink
from ..streaming.upsert import UpsertTable
from .card import ALL_OUTPUTS, SINK_RETRIES, Sources, full_application, simple_application, table_sinks

# The topics.
CUSTOMER_TOPIC, VENDOR_TOPIC, TRANSACTION_TOPIC = "customer", "vendor", "transaction"

Topics = Callable[[str], DataFrame]


def kafka_topics(
    spark: SparkSession, properties: Mapping[str, str], reader: Mapping[str, str] | None = None
) -> Topics:
    """Topics by name, from their newest message on unless ``reader`` options say otherwise."""
    return lambda topic: message_stream(spark, properties, topic, options=reader)


def seed_states(spark: SparkSession, base: str) -> UpsertTable:
    """The state table with all states in it."""
    states = UpsertTable(spark, f"{base}/states", TABLES["states"])
    states.load(spark.createDataFrame(STATES, STATE))
    return states


def deployed_sources(spark: SparkSession, topics: Topics, base: str) -> Sources:
    """Static tables below ``base``, streams from topics; customers carry the broker's time."""

    def static(name: str):
        return table_source(UpsertTable(spark, f"{base}/{name}", TABLES[name]))

    return Sources(
        states=static("states"),
        customers=static("customers"),
        vendors=static("vendors"),
        customer_stream=json_source(lambda: topics(CUSTOMER_TOPIC), BROKER_TIME),
        vendor_stream=json_source(lambda: topics(VENDOR_TOPIC), "update_timestamp"),
        transaction_stream=json_source(lambda: topics(TRANSACTION_TOPIC), "event_timestamp"),
    )


def deployed_full(
    spark: SparkSession,
    topics: Topics,
    base: str,
    checkpoint_base: str,
    available_now: bool = False,
    maintenance: Maintenance | None = Maintenance(),
) -> QueryGroup:
    """The full application between topics and tables.

    Customers, vendors and states are looked up as they are at each micro-batch, tables are folded
    now and then, and texts that are no records are kept in a table of their own.
    """
    live = {name: UpsertTable(spark, f"{base}/{name}", TABLES[name]) for name in ("customers", "vendors", "states")}
    group = full_application(
        spark,
        deployed_sources(spark, topics, base),
        table_sinks(spark, base, outputs=ALL_OUTPUTS, live=live, maintenance=maintenance),
        checkpoint_base,
        available_now=available_now,
        live=True,
    )
    group.add(malformed_output(spark, topics, base), checkpoint_base, available_now)
    return group


def malformed_output(spark: SparkSession, topics: Topics, base: str) -> Output:
    """Messages of all topics whose text is no JSON record, with topic, partition and offset."""
    kinds = {CUSTOMER_TOPIC: CUSTOMER, VENDOR_TOPIC: VENDOR, TRANSACTION_TOPIC: TRANSACTION}

    def build() -> DataFrame:
        return reduce(DataFrame.unionByName, [malformed(topics(topic), kind) for topic, kind in kinds.items()])

    return Output(build, upsert_sink(UpsertTable(spark, f"{base}/malformed_messages", TABLES["malformed_messages"]), retries=SINK_RETRIES))


def deployed_simple(
    spark: SparkSession, topics: Topics, base: str, checkpoint_base: str, available_now: bool = False
) -> QueryGroup:
    """The simple application between a topic and tables."""
    customers = UpsertTable(spark, f"{base}/customers", TABLES["customers"])
    sinks = {
        name: upsert_sink(UpsertTable(spark, f"{base}/{name}", TABLES[name]), retries=SINK_RETRIES)
        for name in ("transactions", "operational_metadata")
    }
    return simple_application(
        spark,
        table_source(customers),
        json_source(lambda: topics(TRANSACTION_TOPIC), view=TRANSACTION_TOPIC),
        sinks,
        checkpoint_base,
        available_now,
    )


def main(argv: list[str]) -> int:
    options = dict(a.split("=", 1) for a in argv[4:] if "=" in a)
    known = all(o == "seconds" or o.startswith(("restart.", "reader.")) for o in options)
    if len(argv) < 4 or argv[0] not in ("full", "simple") or len(options) != len(argv) - 4 or not known:
        print(__doc__, file=sys.stderr)
        return 2
    kind, properties, base, checkpoints = argv[:4]
    spark = SparkSession.builder.appName(f"brooklet-{kind}").getOrCreate()
    topics = kafka_topics(spark, properties_file(properties), with_prefix(options, "reader."))
    group = (deployed_full if kind == "full" else deployed_simple)(spark, topics, base, checkpoints)
    group.start()
    seconds = float(options["seconds"]) if "seconds" in options else None
    group.await_termination(seconds, {q: float(s) for q, s in with_prefix(options, "restart.").items()})
    group.stop()
    return 0
