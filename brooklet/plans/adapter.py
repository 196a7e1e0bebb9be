"""The given tables as the entities of the flows.

``events`` plays the transactions, ``customer`` and ``supplier`` the static tables, ``nation`` the
states. Every table is used whole. The rules are plain arithmetic on the columns, so that SQL can
state them too; they plant missing fields, unknown keys and values outside the domains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import parquet_stream
from ..streaming.sinks import to_messages

EVENT_STATE_OF = {
    "view": "CREATED",
    "click": "SWIPED",
    "purchase": "AUTHORIZED",
    "signup": "INVALID",
}
CARD_OF = {0: "Credit", 1: "Debit", 2: "Whatever"}
SIMPLE_STATE_OF = {"view": "created", "click": "swiped", "purchase": "Created"}
SIMPLE_CARD_OF = {0: "Visa", 1: "MasterCard", 2: "visa"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(key: Column, values: dict) -> Column:
    chain = F.when(key == F.lit(next(iter(values))), F.lit(next(iter(values.values()))))
    for k, v in list(values.items())[1:]:
        chain = chain.when(key == F.lit(k), F.lit(v))
    return chain


def transactions_from(
    events: DataFrame, states: dict[str, str] = EVENT_STATE_OF, cards: dict[int, str] = CARD_OF
) -> DataFrame:
    """Events as transactions, with the event time repeated as ``timestamp``.

    The last digit in ``props`` decides which of customer, vendor and price is missing.
    """
    digit = F.substring("props", -2, 1)
    vendor = F.floor((F.col("user_id") * 7 + F.col("event_id") % 60) / 10)
    when = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.when(~digit.isin("0", "1"), (F.col("user_id") * 11).cast("int")).alias("customer_id"),
        F.when(~digit.isin("2", "3"), vendor.cast("int")).alias("vendor_id"),
        _lookup(F.col("event_type"), states).alias("event_state"),
        when.alias("event_timestamp"),
        F.when(
            digit != "4", F.round(F.col("value") * 100).cast("bigint").cast("string")
        ).alias("price"),
        _lookup(F.col("event_id") % 4, cards).alias("card_type"),
        when.alias("timestamp"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(table(spark, sf_dir, "events"))


def simple_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions_from(table(spark, sf_dir, "events"), SIMPLE_STATE_OF, SIMPLE_CARD_OF)
    return rows.drop("timestamp")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet_stream(spark, f"{sf_dir}/events.parquet")


def transaction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(event_stream(spark, sf_dir))


def customers_from(rows: DataFrame) -> DataFrame:
    """Customers as a stream would bring them; some of their state ids are not known."""
    return rows.select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        (F.col("c_nationkey") + 2).cast("int").alias("state_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        _updated("c_custkey").alias("update_timestamp"),
    )


def vendors_from(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("s_suppkey").cast("int").alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.format_string("+1-%03d", F.col("s_nationkey")).alias("phone_number"),
        _updated("s_suppkey").alias("update_timestamp"),
    )


def _updated(key: str) -> Column:
    """2018-01-01 and as many seconds as the key says."""
    return F.timestamp_seconds(F.lit(1514764800) + F.col(key))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_from(table(spark, sf_dir, "customer"))


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendors_from(table(spark, sf_dir, "supplier"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation")
    return rows.select(
        F.col("n_nationkey").alias("state_id"),
        F.col("n_name").alias("state_name"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("state_abbreviation"),
    )


def lineitem_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as the events of transactions: several events per transaction."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
        F.concat("l_returnflag", F.lit("_"), "l_linestatus").alias("event_state"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").cast("int").alias("vendor_id"),
    )


def as_messages(rows: DataFrame, key: str | None, offset: Column, ts: Column) -> DataFrame:
    """Rows as the records of a message log: JSON values, an offset and the broker's time."""
    placed = rows.withColumns({"_offset": offset, "_time": ts})
    messages = to_messages(placed, key, "yyyy-MM-dd HH:mm:ss.SSSSSS", ("_offset", "_time"))
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("transaction").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("_offset").alias("offset"),
        F.col("_time").alias("timestamp"),
    )
