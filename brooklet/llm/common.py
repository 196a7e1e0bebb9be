"""Helpers of the operators in this package: shared scratch folders, and words of many texts at once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that one vectorised step takes at once; a longer text is a step of its own.
CHUNK_BYTES = 2 << 20

#: Bits of the table that thins rows out before an exchange: 2 ** 18 rows of 64 bits, about 8 MB.
MARK_BITS = 1 << 24

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
#: Odd bases of the polynomial hashes, both 3 modulo 8.
BASE = np.uint64(0x9E3779B97F4A7C13)
BASE_2 = np.uint64(0xD6E8FEB86659FD9B)

#: Bytes of words that white space parts: all but blank, tab, line feed, vertical tab, form feed, return.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of letters and digits: ASCII letters and digits, and all that is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


#: Settings for jobs on long texts: rows of an Arrow batch, whose buffers count as memory on both sides, and of a batch of the
#: Parquet reader, whose vectors of text double until they hold it.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.parquet.columnarReaderBatchSize": "1000"}

@contextmanager
def settings(spark: SparkSession, **wanted: str) -> Iterator[None]:
    """The session's settings for the jobs within; its own come back."""
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset, as in tests, it
    is a folder of the local machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        import tempfile

        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = tempfile.mkdtemp(prefix="brooklet-llm-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table, so that a lost executor costs no more than its own tasks."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_among(df: DataFrame, name: str, keys: DataFrame) -> DataFrame:
    """Rows whose 64-bit hash ``name`` may be one of ``keys`` (a frame with that column), before a join on it.

    The keys set bits in a table of fixed size, at most ``MARK_BITS`` / 64 rows, which is broadcast. No
    row of a key is lost; others pass where bits coincide, and the join that follows tells them apart.
    With many more keys than bits all rows pass, so this only saves bytes of an exchange.
    """
    def word(hashed: Column) -> Column:
        return F.shiftright(hashed.bitwiseAND(F.lit(MARK_BITS - 1)), 6)

    def bit(hashed: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), hashed.bitwiseAND(F.lit(63)).cast("int"))

    marks = keys.groupBy(word(F.col(name)).alias("word")).agg(F.bit_or(bit(F.col(name))).alias("bits"))
    marked = (word(df[name]) == marks["word"]) & (marks["bits"].bitwiseAND(bit(df[name])) != 0)
    return df.join(F.broadcast(marks), marked, "left_semi")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pairs_hash(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit name for each ordered pair."""
    return mixed(a * BASE + mixed(b + BASE_2))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(1 << 12)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a text column: first row, offsets of the rows, and the UTF-8 bytes. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, len(texts))
        yield first, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        first = last


def words(offsets: np.ndarray, data: np.ndarray, kept: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, row and 64-bit hash of all words: maximal runs of ``kept`` bytes within a row.

    ``fold`` hashes A-Z as a-z. Different words share a hash with a chance of about 2**-64.
    """
    global _POWERS
    inside = kept[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    lengths = ends - starts
    if lengths.max() > len(_POWERS):
        _POWERS = powers(int(lengths.max()))
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    sums = np.add.reduceat((_BYTE_FOLDED if fold else _BYTE)[data[inside]] * _POWERS[place], first)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows, mixed(sums + lengths.astype(np.uint64) * BASE_2)


def row_ranges(rows: np.ndarray, n: int) -> np.ndarray:
    """Bounds of each row's entries in a sorted list of row numbers: ``n + 1`` values."""
    return np.searchsorted(rows, np.arange(n + 1))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
