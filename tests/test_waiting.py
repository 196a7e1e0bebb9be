"""Messages that wait for their schema in keyed state."""

from datetime import timedelta
from types import SimpleNamespace

import pandas as pd
import pytest

import samples
from brooklet.schemas import BYTES, INT, LONG, TEXT, TIME, TableSpec, struct
from brooklet.sources.files import parquet_stream
from brooklet.streaming.group import Output, QueryGroup
from brooklet.streaming.sinks import upsert_sink
from brooklet.streaming.upsert import UpsertTable
from brooklet.streaming.waiting import _NO_TIME, STATE_STORE, _Waiting, await_schemas, rocks_db

MESSAGE = struct(offset=LONG, schema_id=INT, body=BYTES, timestamp=TIME)
SCHEMA = struct(id=INT, name=TEXT, version=INT, avro_schema=TEXT, timestamp=TIME)
OUT = struct(offset=LONG, schema_id=INT, body=BYTES, timestamp=TIME, writer_name=TEXT, version=INT, avro_schema=TEXT)


def at(minute):
    return samples.at(f"2022-01-01 {minute // 60:02d}:{minute % 60:02d}:00")


@pytest.fixture
def running(spark, tmp_path):
    """A query over messages and schemas, and a way to add some of both and get all that has come out."""
    spark.createDataFrame([], MESSAGE).write.parquet(f"{tmp_path}/messages")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/schemas")
    table = UpsertTable(spark, f"{tmp_path}/out", TableSpec("out", OUT, ("offset",), buckets=1))

    def build():
        return await_schemas(parquet_stream(spark, f"{tmp_path}/messages"), parquet_stream(spark, f"{tmp_path}/schemas"), timedelta(minutes=10), salts=2)

    group = QueryGroup(spark, [Output(build, upsert_sink(table))], f"{tmp_path}/cp")
    before = spark.conf.get(STATE_STORE)

    def add(messages=(), schemas=()):
        if messages:
            spark.createDataFrame(list(messages), MESSAGE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/messages")
        if schemas:
            spark.createDataFrame(list(schemas), SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/schemas")
        group.drain()
        return {r["offset"]: (r["writer_name"], r["version"]) for r in table.read().collect()}

    with rocks_db(spark):
        group.start()
        yield add, group
        group.stop()
    assert spark.conf.get(STATE_STORE) == before


def test_messages_wait_for_their_schema_or_for_the_end_of_patience(running):
    add, group = running
    assert add([(i, 7, b"x", at(0)) for i in range(6)] + [(9, 8, None, at(1))]) == {}
    seven = ("item", 2)
    got = add(schemas=[(7, "item", 2, "{}", at(5)), (6, "other", 1, "{}", at(5))])
    assert got == {i: seven for i in range(6)}
    # From now on the schema is there, also after a restart; the other message is given up.
    group.restart("out")
    got = add([(20, 7, b"y", at(12)), (21, 6, b"z", at(12)), (22, 5, b"z", at(12))])
    assert got == {**{i: seven for i in range(6)}, 20: seven, 21: ("other", 1), 9: (None, None)}
    # The schema of a message that has been given up helps later messages only.
    got = add([(23, 8, b"z", at(14))], [(8, "late", 1, "{}", at(14))])
    assert got[9] == (None, None) and got[23] == ("late", 1) and 22 not in got


class Kept:
    """State of one key, in plain dictionaries."""

    def __init__(self):
        self.packs, self.timers = {}, set()
        self.registerTimer, self.deleteTimer, self.listTimers = self.timers.add, self.timers.discard, lambda: list(self.timers)
        self.keys, self.getValue, self.removeKey, self.updateValue = lambda: list(self.packs), self.packs.get, self.packs.pop, self.packs.__setitem__
        self.exists = lambda: False
        self.getMapState = self.getValueState = lambda *names: self


def test_the_state_holds_packs_of_messages():
    kept, made = Kept(), _Waiting(timedelta(minutes=10))
    made.init(kept)
    minute = 60_000_000
    micros = [n * minute + i for n in (0, 5) for i in range(500)] + [_NO_TIME]
    rows = pd.DataFrame({"offset": [(1 << 60) + i for i in range(1001)], "no_offset": False, "body": b"x", "micros": micros, "writer_name": None, "version": None, "avro_schema": None})
    assert list(made.handleInputRows((7, 0), iter([rows]), None)) == []
    assert len(kept.packs) <= 5 and len(kept.timers) <= 4
    moment = SimpleNamespace(getCurrentWatermarkInMs=lambda: 14 * 60_000, getExpiryTimeInMs=lambda: 10 * 60_000)
    given_up = pd.concat(made.handleExpiredTimer((7, 0), moment, moment))
    assert sorted(given_up["offset"]) == [(1 << 60) + i for i in range(500)] and given_up["avro_schema"].isna().all()
    told = pd.DataFrame({"offset": [0], "no_offset": True, "body": None, "micros": _NO_TIME, "writer_name": "late", "version": 3.0, "avro_schema": "{}"})
    kept.update = lambda schema: None
    rest = pd.concat(made.handleInputRows((7, 0), iter([told]), None))
    assert sorted(rest["offset"]) == [(1 << 60) + i for i in range(500, 1001)] and set(rest["version"]) == {3}
    assert not kept.packs and not kept.timers
