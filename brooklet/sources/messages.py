"""Message logs as rows.

Every function here works on any frame with the columns ``key, value, offset, timestamp`` that a
message log gives, static or streaming. Only ``message_stream`` and ``message_backlog`` need the
Kafka connector on the class path.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.parse import once
from ..functions.text import nth_field
from ..schemas import EVENT_TIME

Source = Callable[[StructType], DataFrame]

BROKER_TIME = object()
CLIENT_PREFIX = "kafka."


def read_properties(text: str) -> dict[str, str]:
    """Keys and values of a Java properties text: comments, ``=``, ``:`` or blank as separator."""
    properties: dict[str, str] = {}
    logical = text.replace("\\\r\n", "\\\n").split("\\\n")
    joined = logical[0] + "".join(part.lstrip() for part in logical[1:])
    for line in joined.splitlines():
        line = line.strip()
        if not line or line[0] in "#!":
            continue
        cut = next((i for i, c in enumerate(line) if c in "=: \t"), len(line))
        key, rest = line[:cut], line[cut:].lstrip(" \t")
        if rest[:1] in ("=", ":"):
            rest = rest[1:]
        properties[key] = rest.strip()
    return properties


def properties_file(path: str) -> dict[str, str]:
    return read_properties(Path(path).read_text(encoding="latin-1"))


def broker_properties(servers: str) -> dict[str, str]:
    """Client settings for brokers without encryption."""
    return {"bootstrap.servers": servers, "security.protocol": "PLAINTEXT"}


def with_prefix(settings: Mapping[str, str], prefix: str) -> dict[str, str]:
    """The settings whose key starts with the prefix, without it."""
    return {k[len(prefix):]: v for k, v in settings.items() if k.startswith(prefix)}


def kafka_options(
    properties: Mapping[str, str],
    topic: str,
    starting: str = "latest",
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options: client settings under the connector's prefix, topic, start position, and any of the
    reader's own ``options``, such as ``maxOffsetsPerTrigger``, as they are."""
    found = {CLIENT_PREFIX + key: value for key, value in properties.items()}
    return found | {"subscribe": topic, "startingOffsets": starting} | dict(options or {})


def message_stream(
    spark: SparkSession,
    properties: Mapping[str, str],
    topic: str,
    starting: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic as a stream of messages."""
    found = kafka_options(properties, topic, starting, options)
    return spark.readStream.format("kafka").options(**found).load()


def message_backlog(spark: SparkSession, properties: Mapping[str, str], topic: str) -> DataFrame:
    """Everything a topic holds at the time of the read, as a static frame."""
    options = kafka_options(properties, topic, "earliest") | {"endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load()


def parse_json(
    messages: DataFrame,
    schema: StructType,
    event_time: str | object | None = None,
    raw: str | None = None,
) -> DataFrame:
    """JSON messages as rows of the given schema.

    ``event_time`` is ``BROKER_TIME`` to take the message's own time, or a field of the record;
    it appears as ``timestamp``. A text that does not parse gives a row of NULLs; ``raw`` names a
    column that keeps the text.
    """
    text = F.col("value").cast("string")
    kept = []
    if event_time is BROKER_TIME:
        kept.append(F.col("timestamp").alias(EVENT_TIME))
    if raw is not None:
        kept.append(text.alias(raw))
    rows = messages.select(once(F.from_json(text, schema)), *kept)
    if event_time is None or event_time is BROKER_TIME:
        return rows
    return rows.withColumn(EVENT_TIME, F.col(event_time))


def malformed(messages: DataFrame, schema: StructType) -> DataFrame:
    """Messages whose text is not a JSON object of this schema, raw, with the place they came from."""
    text = F.col("value").cast("string")
    broken = "_corrupt_record"
    parsed = F.from_json(text, StructType([*schema.fields, StructField(broken, StringType())]), {"columnNameOfCorruptRecord": broken})
    place = [F.col(c).cast(kind).alias(c) for c, kind in (("topic", "string"), ("partition", "int"), ("offset", "bigint"), ("timestamp", "timestamp"))]
    return messages.where(text.isNull() | parsed[broken].isNotNull()).select(*place, F.col("value").cast("binary").alias("value"))


def parse_text(messages: DataFrame) -> DataFrame:
    """Message values as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def text_records(messages: DataFrame) -> DataFrame:
    """Offset, key and value as text."""
    return messages.select(
        "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def parse_csv(messages: DataFrame, ddl: str, keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """Delimited values as rows; a bad or missing field is NULL, the others stay."""
    kept = [F.col(c).cast("string").alias(c) if c == "key" else F.col(c) for c in keep]
    return messages.select(*kept, once(F.from_csv(F.col("value").cast("string"), ddl)))


def parse_sightings(messages: DataFrame) -> DataFrame:
    """``millis,lat,lon`` payloads with the time as a timestamp."""
    rows = parse_csv(messages, "millis bigint, lat double, lon double")
    return rows.select("key", F.timestamp_millis("millis").alias("seen_at"), "lat", "lon")


def field_records(messages: DataFrame, n: int, separator: str = ",") -> DataFrame:
    """Offset and the n-th field of each payload."""
    return messages.select(
        "offset", nth_field(F.col("value").cast("string"), n, separator).alias("field")
    )


def json_source(
    messages: Callable[[], DataFrame],
    event_time: str | object | None = None,
    view: str | None = None,
) -> Source:
    """A source over a message log that is opened anew on each call."""

    def load(schema: StructType) -> DataFrame:
        frame = parse_json(messages(), schema, event_time)
        if view is not None:
            frame.createOrReplaceTempView(view)
        return frame

    return load
