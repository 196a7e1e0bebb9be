"""Entity schemas, value domains and keyed-table layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
BOOL, TIME, BYTES = BooleanType(), TimestampType(), BinaryType()


def struct(**columns: DataType) -> StructType:
    """A schema from names and types; unlike a DDL text it needs no running session."""
    return StructType([StructField(name, kind) for name, kind in columns.items()])


EVENT_TIME = "timestamp"

TRANSACTION = struct(
    transaction_id=TEXT,
    customer_id=INT,
    vendor_id=INT,
    event_state=TEXT,
    event_timestamp=TIME,
    price=TEXT,
    card_type=TEXT,
)
VENDOR = struct(
    vendor_id=INT,
    vendor_name=TEXT,
    phone_number=TEXT,
    update_timestamp=TIME,
)
CUSTOMER = struct(
    customer_id=INT,
    state_id=INT,
    first_name=TEXT,
    last_name=TEXT,
    update_timestamp=TIME,
)
STATE = struct(
    state_id=INT,
    state_name=TEXT,
    state_abbreviation=TEXT,
)
STORED_CUSTOMER = struct(
    customer_id=INT,
    first_name=TEXT,
    last_name=TEXT,
    state_name=TEXT,
    state_abbreviation=TEXT,
    update_timestamp=TIME,
)
CUSTOMER_ORPHAN = struct(
    customer_id=INT,
    first_name=TEXT,
    last_name=TEXT,
    state_id=INT,
    update_timestamp=TIME,
)
WINDOW_COUNT = struct(
    start_ts=TIME,
    end_ts=TIME,
    num_transactions=LONG,
)
SIMPLE_TRANSACTION = struct(
    transaction_id=TEXT,
    customer_id=INT,
    vendor_id=INT,
    event_state=TEXT,
    event_timestamp=TIME,
    price=TEXT,
    card_type=TEXT,
    customer_first_name=TEXT,
    customer_last_name=TEXT,
    is_valid=BOOL,
)
MESSAGE = struct(
    key=BYTES,
    value=BYTES,
    topic=TEXT,
    partition=INT,
    offset=LONG,
    timestamp=TIME,
)
REGISTRY = struct(
    id=INT,
    name=TEXT,
    version=INT,
    avro_schema=TEXT,
    parsing_form=TEXT,
)

TRANSACTION_COLUMNS = TRANSACTION.fieldNames()

# Which columns a transaction needs and which values count as valid.
MANDATORY_FIELDS = ["customer_id", "vendor_id", "event_timestamp"]
CARD_TYPES = ["Credit", "Debit"]
EVENT_STATES = ["CREATED", "SWIPED", "CANCELLED", "SIG_REQD", "AUTHORIZED", "DECLINED"]
SIMPLE_CARD_TYPES = ["Visa", "MasterCard"]
SIMPLE_EVENT_STATES = ["created"]

# The state table; -1 stands for a customer whose state is not known.
STATES = [
    (-1, "Unknown", "??"),
    (1, "Alabama", "AL"),
    (2, "Alaska", "AK"),
    (3, "Arizona", "AZ"),
    (4, "Arkansas", "AR"),
    (5, "California", "CA"),
    (6, "Colorado", "CO"),
    (7, "Connecticut", "CT"),
    (8, "Delaware", "DE"),
    (9, "District of Columbia", "DC"),
    (10, "Florida", "FL"),
    (11, "Georgia", "GA"),
    (12, "Hawaii", "HI"),
    (13, "Idaho", "ID"),
    (14, "Illinois", "IL"),
    (15, "Indiana", "IN"),
    (16, "Iowa", "IA"),
    (17, "Kansas", "KS"),
    (18, "Kentucky", "KY"),
    (19, "Louisiana", "LA"),
    (20, "Maine", "ME"),
    (21, "Maryland", "MD"),
    (22, "Massachusetts", "MA"),
    (23, "Michigan", "MI"),
    (24, "Minnesota", "MN"),
    (25, "Mississippi", "MS"),
    (26, "Missouri", "MO"),
    (27, "Montana", "MT"),
    (28, "Nebraska", "NE"),
    (29, "Nevada", "NV"),
    (30, "New Hampshire", "NH"),
    (31, "New Jersey", "NJ"),
    (32, "New Mexico", "NM"),
    (33, "New York", "NY"),
    (34, "North Carolina", "NC"),
    (35, "North Dakota", "ND"),
    (36, "Ohio", "OH"),
    (37, "Oklahoma", "OK"),
    (38, "Oregon", "OR"),
    (39, "Pennsylvania", "PA"),
    (40, "Rhode Island", "RI"),
    (41, "South Carolina", "SC"),
    (42, "South Dakota", "SD"),
    (43, "Tennessee", "TN"),
    (44, "Texas", "TX"),
    (45, "Utah", "UT"),
    (46, "Vermont", "VT"),
    (47, "Virginia", "VA"),
    (48, "Washington", "WA"),
    (49, "West Virginia", "WV"),
    (50, "Wisconsin", "WI"),
    (51, "Wyoming", "WY"),
]


# Which version of a key a table keeps.
LAST, FIRST = "last", "first"


@dataclass(frozen=True)
class TableSpec:
    """Layout of a keyed table.

    ``key`` is the primary key. ``buckets`` hash buckets over ``hash_columns`` (the key when
    empty) and calendar months of ``range_column`` become partition folders. ``order_by`` breaks
    ties between two versions of a key written by the same micro-batch. A table keeps the last version
    of a key, or the first: then a key that is there is never written again.
    """

    name: str
    schema: StructType
    key: tuple[str, ...]
    hash_columns: tuple[str, ...] = ()
    buckets: int = 10
    range_column: str | None = None
    order_by: tuple[str, ...] = ()
    keep: str = LAST

    def __post_init__(self) -> None:
        names = set(self.schema.fieldNames())
        for column in (*self.key, *self.hash_columns, *self.order_by):
            if column not in names:
                raise ValueError(f"{self.name}: no column {column}")
        if not self.key:
            raise ValueError(f"{self.name}: a keyed table needs a key")
        if self.keep not in (LAST, FIRST):
            raise ValueError(f"{self.name}: keep is {LAST!r} or {FIRST!r}")
        if self.buckets < 1:
            raise ValueError(f"{self.name}: buckets must be positive")
        # Pruning by bucket or month is only right where both follow from the key.
        if not set(self.hash_columns) <= set(self.key):
            raise ValueError(f"{self.name}: hash columns must belong to the key")
        if self.range_column is not None and self.range_column not in self.key:
            raise ValueError(f"{self.name}: the range column must belong to the key")

    @property
    def bucket_columns(self) -> tuple[str, ...]:
        return self.hash_columns or self.key


TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("customers", STORED_CUSTOMER, ("customer_id",), order_by=("update_timestamp",)),
        TableSpec("vendors", VENDOR, ("vendor_id",), order_by=("update_timestamp",)),
        TableSpec("states", STATE, ("state_id",), buckets=1),
        TableSpec(
            "valid_transactions",
            TRANSACTION,
            ("event_timestamp", "transaction_id"),
            hash_columns=("transaction_id",),
            buckets=15,
            range_column="event_timestamp",
        ),
        TableSpec(
            "invalid_transactions",
            TRANSACTION,
            ("transaction_id",),
            buckets=15,
            order_by=("event_timestamp",),
        ),
        TableSpec(
            "undecided_transactions",
            TRANSACTION,
            ("transaction_id",),
            buckets=15,
            order_by=("event_timestamp",),
        ),
        TableSpec(
            "customer_orphans",
            CUSTOMER_ORPHAN,
            ("customer_id",),
            buckets=1,
            order_by=("update_timestamp",),
            keep=FIRST,
        ),
        TableSpec(
            "vendor_orphans",
            VENDOR,
            ("vendor_id",),
            buckets=1,
            order_by=("update_timestamp",),
            keep=FIRST,
        ),
        TableSpec(
            "malformed_messages",
            struct(topic=TEXT, partition=INT, offset=LONG, timestamp=TIME, value=BYTES),
            ("topic", "partition", "offset"),
            buckets=1,
        ),
        TableSpec("transactions_operational_metadata", WINDOW_COUNT, ("start_ts",), buckets=1),
        TableSpec(
            "transactions",
            SIMPLE_TRANSACTION,
            ("event_timestamp", "transaction_id"),
            hash_columns=("transaction_id",),
            buckets=15,
            range_column="event_timestamp",
        ),
        TableSpec("operational_metadata", WINDOW_COUNT, ("start_ts",), buckets=1),
    )
}
