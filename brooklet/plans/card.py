"""Card transactions: the flows, and the two applications that run them as streaming queries.

A flow takes frames and gives named frames. It does not know where they come from or go to, and
works on static frames and on streams.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import enrich, mark_known, orphans
from ..operators.validate import INVALID, UNDECIDED, VALID, flag_record, split, validate
from ..operators.windows import count_by_window, window_metrics, with_watermark
from ..schemas import (
    CARD_TYPES,
    CUSTOMER,
    EVENT_STATES,
    EVENT_TIME,
    MANDATORY_FIELDS,
    SIMPLE_CARD_TYPES,
    SIMPLE_EVENT_STATES,
    STATE,
    TABLES,
    TRANSACTION,
    TRANSACTION_COLUMNS,
    VENDOR,
)
from ..sources.messages import Source
from ..streaming.group import Output, QueryGroup
from ..streaming.live import Clock, Moment
from ..streaming.sinks import Maintenance, Sink, fan_out_sink, upsert_sink
from ..streaming.upsert import UpsertTable

DELAY = "10 seconds"
SIMPLE_DELAY = "1 minute"
WIDTH = "1 minute"

# What an orphan's row holds besides its key.
UNKNOWN = "Unknown"
UNKNOWN_STATE = -1


def customer_orphan_columns(clock: Column | None = None) -> dict[str, Column]:
    return {
        "first_name": F.lit(UNKNOWN),
        "last_name": F.lit(UNKNOWN),
        "state_id": F.lit(UNKNOWN_STATE),
        "update_timestamp": F.current_timestamp() if clock is None else clock,
    }


def vendor_orphan_columns(clock: Column | None = None) -> dict[str, Column]:
    return {
        "vendor_name": F.lit(UNKNOWN),
        "phone_number": F.lit(UNKNOWN),
        "update_timestamp": F.current_timestamp() if clock is None else clock,
    }


def validated(transactions: DataFrame) -> DataFrame:
    """Transactions with all check flags."""
    domains = {"card_type": CARD_TYPES, "event_state": EVENT_STATES}
    return validate(transactions, MANDATORY_FIELDS, domains, "event_timestamp")


def routed(transactions: DataFrame) -> dict[str, DataFrame]:
    """Valid, invalid and undecided transactions in the columns of the stored tables."""
    parts = split(validated(transactions))
    return {route: part.select(*TRANSACTION_COLUMNS) for route, part in parts.items()}


def customer_orphans(
    valid: DataFrame, customers: DataFrame, dedup: str = "batch", clock: Column | None = None
) -> DataFrame:
    return orphans(valid, customers, "customer_id", customer_orphan_columns(clock), dedup)


def vendor_orphans(
    valid: DataFrame, vendors: DataFrame, dedup: str = "batch", clock: Column | None = None
) -> DataFrame:
    return orphans(valid, vendors, "vendor_id", vendor_orphan_columns(clock), dedup)


def customers_flow(customers: DataFrame, states: DataFrame) -> DataFrame:
    """Customers with the name of their state instead of its id."""
    rows = with_watermark(customers, EVENT_TIME, DELAY) if EVENT_TIME in customers.columns else customers
    named = enrich(
        rows,
        states,
        "state_id",
        {"state_name": "state_name", "state_abbreviation": "state_abbreviation"},
    )
    return named.select(
        "customer_id",
        "first_name",
        "last_name",
        "state_name",
        "state_abbreviation",
        F.col("update_timestamp").cast("timestamp").alias("update_timestamp"),
    )


def vendors_flow(vendors: DataFrame) -> DataFrame:
    """Vendors as they come."""
    rows = with_watermark(vendors, EVENT_TIME, DELAY) if EVENT_TIME in vendors.columns else vendors
    return rows.select(
        "vendor_id",
        "vendor_name",
        "phone_number",
        F.col("update_timestamp").cast("timestamp").alias("update_timestamp"),
    )


def operational_metadata(transactions: DataFrame) -> DataFrame:
    """All transactions per minute, valid or not; the rows bring their watermark."""
    return count_by_window(transactions, EVENT_TIME, WIDTH, None)


def transactions_flow(
    transactions: DataFrame, customers: DataFrame, vendors: DataFrame, dedup: str = "batch"
) -> dict[str, DataFrame]:
    """All outputs of the transactions; counts cover every transaction, orphans the valid ones."""
    rows = with_watermark(transactions, EVENT_TIME, DELAY)
    routes = routed(rows)
    return {
        "invalid_transactions": routes[INVALID],
        "valid_transactions": routes[VALID],
        "undecided_transactions": routes[UNDECIDED],
        "customer_orphans": customer_orphans(routes[VALID], customers, dedup),
        "vendor_orphans": vendor_orphans(routes[VALID], vendors, dedup),
        "transactions_operational_metadata": operational_metadata(rows),
    }


def rich_metadata(
    transactions: DataFrame,
    customers: DataFrame,
    vendors: DataFrame,
    ts: str = "event_timestamp",
    delay: str | None = DELAY,
) -> DataFrame:
    """Per window: rows, average price, rows per outcome, and references to unknown keys."""
    narrow = with_watermark(validated(transactions), ts, delay).select(
        ts, "customer_id", "vendor_id", "price", "valid_record", "transaction_id"
    )
    known = mark_known(narrow, customers, "customer_id", "known_customer")
    known = mark_known(known, vendors, "vendor_id", "known_vendor")
    valid = F.col("valid_record")
    flags = {
        "num_valid": valid,
        "num_invalid": ~valid,
        "num_undecided": valid.isNull(),
        "num_customer_orphans": valid & ~F.col("known_customer"),
        "num_vendor_orphans": valid & ~F.col("known_vendor"),
    }
    return window_metrics(known, ts, WIDTH, None, flags)


def simple_flow(transactions: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    """Transactions with the customer's name and one validity flag, and counts per minute."""
    rows = with_watermark(transactions, "event_timestamp", SIMPLE_DELAY)
    named = enrich(
        transactions,
        customers,
        "customer_id",
        {"customer_first_name": "first_name", "customer_last_name": "last_name"},
    )
    domains = {"card_type": SIMPLE_CARD_TYPES, "event_state": SIMPLE_EVENT_STATES}
    return {
        "transactions": flag_record(named, domains),
        "operational_metadata": count_by_window(rows, "event_timestamp", WIDTH, None),
    }


@dataclass(frozen=True)
class Sources:
    """Where the inputs come from; each source is called with the schema it has to give."""

    states: Source
    customers: Source
    vendors: Source
    customer_stream: Source
    vendor_stream: Source
    transaction_stream: Source


# The outputs of the full application in starting order.
OUTPUTS = [
    "invalid_transactions",
    "valid_transactions",
    "customer_orphans",
    "vendor_orphans",
    "customers",
    "vendors",
    "transactions_operational_metadata",
]
# With the records that are neither valid nor invalid, which the reference writes nowhere.
ALL_OUTPUTS = [*OUTPUTS, "undecided_transactions"]
SINK_RETRIES = 3


# Which stored table an output is joined with.
JOINED_WITH = {"customer_orphans": "customers", "vendor_orphans": "vendors", "customers": "states"}


def join_live(name: str, batch: DataFrame, moment: Moment) -> DataFrame:
    """An output of ``JOINED_WITH`` from a micro-batch of its stream and the table as it is now."""
    side = moment.tables[JOINED_WITH[name]]
    if name == "customers":
        return customers_flow(batch, side)
    flow = customer_orphans if name == "customer_orphans" else vendor_orphans
    return flow(batch, side, clock=F.lit(moment.clock))


def table_sinks(
    spark: SparkSession,
    base: str,
    trigger_seconds: float | None = None,
    outputs: Sequence[str] = tuple(OUTPUTS),
    live: Mapping[str, UpsertTable] | None = None,
    clock: Clock | None = None,
    maintenance: Maintenance | None = None,
) -> dict[str, Sink]:
    """A keyed table below ``base`` for each output of the full application.

    With ``live`` (stored tables by name) the outputs of ``JOINED_WITH`` are joined in every micro-batch
    with the version that is current then; their streams come without the join. ``clock`` gives
    the time of a micro-batch for the orphans it finds.
    """
    # The orphans of a micro-batch are folded to one row per key before they are written.
    folded = {"customer_orphans": "customer_id", "vendor_orphans": "vendor_id"}

    def sink(name: str) -> Sink:
        joined = bool(live) and name in JOINED_WITH
        return upsert_sink(
            UpsertTable(spark, f"{base}/{name}", TABLES[name]),
            retries=SINK_RETRIES,
            trigger_seconds=trigger_seconds,
            prepare=(lambda batch: batch.dropDuplicates([folded[name]])) if name in folded else None,
            join=(lambda batch, moment: join_live(name, batch, moment)) if joined else None,
            live={JOINED_WITH[name]: live[JOINED_WITH[name]]} if joined else None,
            clock=clock,
            maintenance=maintenance,
        )

    return {name: sink(name) for name in outputs}


def full_application(
    spark: SparkSession,
    sources: Sources,
    sinks: Mapping[str, Sink],
    checkpoint_base: str,
    before_start: list[Callable[[], None]] | None = None,
    available_now: bool = False,
    dedup: str = "batch",
    shared_pass: Mapping[str, UpsertTable] | None = None,
    live: bool = False,
) -> QueryGroup:
    """One query per sink, from the sources to the sinks.

    ``sinks`` goes by output name. With ``live`` they join the stored tables themselves, as those of
    ``table_sinks`` with live tables do; else a query keeps the tables as they were at its start. With
    ``shared_pass`` (tables by output name) the stateless outputs of the transactions that it
    names come from one query that reads the stream once.
    """

    def build(name: str) -> Callable[[], DataFrame]:
        if live and name in JOINED_WITH:
            return lambda: live_input(name, sources)
        if name == "customers":
            return lambda: customers_flow(sources.customer_stream(CUSTOMER), sources.states(STATE))
        if name == "vendors":
            return lambda: vendors_flow(sources.vendor_stream(VENDOR))
        return lambda: transaction_output(name, sources.transaction_stream(TRANSACTION), sources, dedup)

    outputs = []
    if shared_pass:
        outputs.append(_shared_output(sources, shared_pass))
    outputs += [Output(build(name), sink) for name, sink in sinks.items()]
    return QueryGroup(spark, outputs, checkpoint_base, before_start, available_now)


def live_input(name: str, sources: Sources) -> DataFrame:
    """The stream behind an output of ``JOINED_WITH``, before the join."""
    if name == "customers":
        return sources.customer_stream(CUSTOMER)
    return routed(with_watermark(sources.transaction_stream(TRANSACTION), EVENT_TIME, DELAY))[VALID]


def transaction_output(
    name: str, transactions: DataFrame, sources: Sources, dedup: str = "batch"
) -> DataFrame:
    """One output of the transactions; opens no static table that it does not need."""
    rows = with_watermark(transactions, EVENT_TIME, DELAY)
    if name == "transactions_operational_metadata":
        return operational_metadata(rows)
    routes = routed(rows)
    if name == "customer_orphans":
        return customer_orphans(routes[VALID], sources.customers(CUSTOMER), dedup)
    if name == "vendor_orphans":
        return vendor_orphans(routes[VALID], sources.vendors(VENDOR), dedup)
    return routes[name.removesuffix("_transactions")]


SHARED_QUERY = "transactions_shared_pass"


def _shared_output(sources: Sources, tables: Mapping[str, UpsertTable]) -> Output:
    if "transactions_operational_metadata" in tables:
        raise ValueError("counts per window need their own query: they keep state")

    def derive(name: str) -> Callable[[DataFrame], DataFrame]:
        return lambda batch: transaction_output(name, batch, sources)

    derived = {name: (derive(name), table) for name, table in tables.items()}
    sink = fan_out_sink(SHARED_QUERY, derived, SINK_RETRIES)
    return Output(lambda: sources.transaction_stream(TRANSACTION), sink)


def simple_application(
    spark: SparkSession,
    customers: Source,
    transaction_stream: Source,
    sinks: Mapping[str, Sink],
    checkpoint_base: str,
    available_now: bool = False,
) -> QueryGroup:
    """The two outputs of the simple flow as queries."""

    def build(name: str) -> Callable[[], DataFrame]:
        return lambda: simple_flow(transaction_stream(TRANSACTION), customers(CUSTOMER))[name]

    outputs = [Output(build(name), sink) for name, sink in sinks.items()]
    return QueryGroup(spark, outputs, checkpoint_base, None, available_now)
