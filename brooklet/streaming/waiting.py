"""Messages that wait for their schema, as keyed state of a stream."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The setting that keyed state with timers needs, and its value.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Messages in one value of the state: bytes of their bodies, and milliseconds between their deadlines.
PACK_BYTES = 4 << 20
PACK_MILLIS = 60_000

#: A message whose columns are never null, but for the body; times are numbers, so no time zone touches them.
_MESSAGE = ["offset", "no_offset", "body", "micros"]
_NO_TIME = -(1 << 63)
_NO_DEADLINE = (1 << 63) - 1
_SCHEMA = "writer_name string, version int, avro_schema string"
_OUT = f"offset bigint, no_offset boolean, schema_id int, body binary, micros bigint, {_SCHEMA}"


class _Waiting(StatefulProcessor):
    """One schema id, and a share of its messages: the schema if it has come, else the messages so far, in packs."""

    def __init__(self, patience: timedelta) -> None:
        self.patience = round(patience.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.schema = handle.getValueState("schema", _SCHEMA)
        self.waiting = handle.getMapState("waiting", "deadline bigint, name string", "pack binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = tuple(self.schema.get()) if self.schema.exists() else None
        came, stored = known, False
        for part in rows:
            told = part["avro_schema"].notna()
            if told.any():
                name, version, text = part.loc[told, ["writer_name", "version", "avro_schema"]].iloc[-1]
                came = (name, None if pd.isna(version) else int(version), text)
            messages = part.loc[~told, _MESSAGE]
            if not len(messages):
                continue
            if came is None:
                self._store(messages)
                stored = True
            else:
                yield self._out(key, messages, came)
        if came is None:
            return
        if came != known:
            self.schema.update(came)
        if known is None or stored:
            for name in list(self.waiting.keys()):
                yield self._out(key, self._taken(name), came)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        for name in list(self.waiting.keys()):
            if name[0] > now:
                continue
            messages = self._taken(name)
            over = self._deadlines(messages) <= now
            if not over.all():
                self._store(messages[~over])
            yield self._out(key, messages[over], (None, None, None))

    def _deadlines(self, messages: pd.DataFrame) -> np.ndarray:
        micros = messages["micros"].to_numpy(np.int64)
        return np.where(micros == _NO_TIME, _NO_DEADLINE, -(-micros // 1000) + self.patience)

    def _store(self, messages: pd.DataFrame) -> None:
        """Puts messages into the state, those with deadlines near each other together."""
        deadlines = self._deadlines(messages)
        by = np.argsort(deadlines, kind="stable")
        messages, deadlines = messages.iloc[by], deadlines[by]
        size = np.cumsum([0 if b is None else len(b) for b in messages["body"]])
        place = np.stack([deadlines // PACK_MILLIS, size // PACK_BYTES])
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0).any(axis=0)]))
        for first, last in zip(starts, [*starts[1:], len(messages)], strict=True):
            pack = pa.RecordBatch.from_pandas(messages.iloc[first:last], _PACK, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _PACK) as out:
                out.write_batch(pack)
            deadline = int(deadlines[first])
            self.waiting.updateValue((deadline, uuid.uuid4().hex), (sink.getvalue().to_pybytes(),))
            if deadline != _NO_DEADLINE:
                self.handle.registerTimer(deadline)

    def _taken(self, name: tuple) -> pd.DataFrame:
        """The messages of a pack, which leaves the state."""
        name = tuple(name)
        pack = bytes(self.waiting.getValue(name)[0])
        self.waiting.removeKey(name)
        return pa.ipc.open_stream(pack).read_pandas()

    def _out(self, key, messages: pd.DataFrame, schema: tuple) -> pd.DataFrame:
        name, version, text = schema
        n = len(messages)
        return pd.DataFrame(
            {
                "offset": messages["offset"].to_numpy(),
                "no_offset": messages["no_offset"].to_numpy(),
                "schema_id": np.full(n, key[0], np.int32),
                "body": messages["body"].to_numpy(),
                "micros": messages["micros"].to_numpy(),
                "writer_name": pd.Series([name] * n, dtype=object),
                "version": pd.Series([version] * n, dtype=object),
                "avro_schema": pd.Series([text] * n, dtype=object),
            }
        )


_PACK = pa.schema([("offset", pa.int64()), ("no_offset", pa.bool_()), ("body", pa.binary()), ("micros", pa.int64())])


def await_schemas(
    messages: DataFrame,
    schemas: DataFrame,
    patience: timedelta,
    delay: str = "0 seconds",
    salts: int = 8,
) -> DataFrame:
    """Streamed messages with the schema of their id, as soon as it is there.

    ``messages`` have offset, schema_id, body and timestamp, ``schemas`` id, name, version, avro_schema and
    timestamp; both are streams. A message whose schema is known goes on at once; another waits
    until its schema comes, or until the watermark is ``patience`` past its time, and then goes on
    without one. Gives offset, schema_id, body, timestamp, writer_name, version and avro_schema.

    The messages of an id are dealt over ``salts`` shares, each with the schema, so that an id with a
    large part of the messages is not one task's work. Join ids that a static registry knows
    before, and send only the others here. The session needs ``STATE_STORE`` set to ``ROCKS_DB``.
    """
    share = F.pmod(F.xxhash64("offset"), F.lit(salts)).cast("int")
    time = F.col("timestamp").cast("timestamp")
    waiting = messages.select(
        F.coalesce(F.col("offset").cast("bigint"), F.lit(0).cast("bigint")).alias("offset"),
        F.col("offset").isNull().alias("no_offset"),
        F.col("schema_id").cast("int").alias("schema_id"),
        F.col("body").cast("binary").alias("body"),
        time.alias("timestamp"),
        F.coalesce(F.unix_micros(time), F.lit(_NO_TIME)).alias("micros"),
        share.alias("share"),
    )
    told = schemas.where(F.col("avro_schema").isNotNull()).select(
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(True).alias("no_offset"),
        F.col("id").cast("int").alias("schema_id"),
        time.alias("timestamp"),
        F.lit(_NO_TIME).alias("micros"),
        F.col("name").alias("writer_name"),
        F.col("version").cast("int").alias("version"),
        "avro_schema",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("share"),
    )
    both = waiting.unionByName(told, allowMissingColumns=True).withWatermark("timestamp", delay)
    out = both.groupBy("schema_id", "share").transformWithStateInPandas(_Waiting(patience), _OUT, "append", "eventTime")
    return out.select(
        F.when(~F.col("no_offset"), F.col("offset")).alias("offset"),
        "schema_id",
        "body",
        F.timestamp_micros(F.when(F.col("micros") != _NO_TIME, F.col("micros"))).alias("timestamp"),
        "writer_name",
        "version",
        "avro_schema",
    )


class rocks_db:
    """Sets the state store that ``await_schemas`` needs for the queries started within, and puts the old one back."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(STATE_STORE)
        self.spark.conf.set(STATE_STORE, ROCKS_DB)

    def __exit__(self, *problem) -> None:
        self.spark.conf.set(STATE_STORE, self.before)
