"""Exact removal of long repeats by recompression.

Rounds name runs of equal symbols and pairs of symbols. A name is a hash of what it names, so it is
the same in every document, task and round of the whole corpus without any exchange. Each symbol
carries its *context*: the words that alone decide that it is there. A window of words therefore
holds the same symbols wherever it occurs, and one of them, chosen by what the window holds alone,
stands for it. Spark counts those symbols over the corpus; only windows whose symbol occurs again
are looked at further, first in stretches of windows with the same symbol, then one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brooklet.llm.common import BASE, SPACED, chunks, column, mixed, pairs_hash, powers, words, written

WINDOW = 35
#: Rounds of pairing; runs are named before each of the first two.
ROUNDS = 4
#: Symbols of a window, from its first on, among which one stands for it: one of the most words, up to
#: ``LONG``, as few words occur again by chance; of those the one with the smallest name.
CANDIDATES = 8
LONG = 6

_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Symbols(NamedTuple):
    """Symbols of one round in text order: name, first word, context (first word, end), not a separator."""

    name: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray
    solid: np.ndarray


def _runs(s: Symbols, salt: int) -> Symbols:
    """Names maximal runs of two or more equal symbols."""
    same = np.zeros(len(s.name), bool)
    same[1:] = (s.name[1:] == s.name[:-1]) & s.solid[1:] & s.solid[:-1]
    first = np.flatnonzero(~same)
    last = np.append(first[1:], len(same)) - 1
    length = last - first + 1
    name = np.where(length > 1, pairs_hash(s.name[first], length.astype(np.uint64) + np.uint64(salt << 40)), s.name[first])
    low, high = s.low[np.maximum(first - 1, 0)], s.high[np.minimum(last + 1, len(same) - 1)]
    solid = s.solid[first]
    return Symbols(name, s.start[first], np.where(solid, low, s.low[first]), np.where(solid, high, s.high[last]), solid)


def _pairs(s: Symbols, salt: int) -> Symbols:
    """Names neighbours of which the first is a left symbol and the second a right one, by a bit of their names."""
    right = (mixed(s.name + powers(salt + 1)[salt]) & np.uint64(1)).astype(bool)
    head = np.zeros(len(right), bool)
    head[:-1] = ~right[:-1] & right[1:] & s.solid[:-1] & s.solid[1:]
    tail = np.zeros(len(right), bool)
    tail[1:] = head[:-1]
    before, after = np.roll(s.low, 1), np.roll(s.high, -1)
    alone = s.solid & ~head & ~tail
    low = np.where(alone & right, before, s.low)
    high = np.where(head | (alone & ~right), after, s.high)
    name = s.name.copy()
    at = np.flatnonzero(head)
    name[at] = pairs_hash(s.name[at], s.name[at + 1] + np.uint64(salt))
    kept = ~tail
    return Symbols(name[kept], s.start[kept], low[kept], high[kept], s.solid[kept])


def _stages(name: np.ndarray, solid: np.ndarray) -> list[Symbols]:
    place = np.arange(len(name))
    stages = [Symbols(name, place, place, place + 1, solid)]
    s = stages[0]
    for r in range(1, ROUNDS + 1):
        if r < 3:
            s = _runs(s, r)
        s = _pairs(s, r)
        stages.append(s)
    return stages


def _laid_out(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all rows with a separator before each row and at the end; which are words; first place and word count of each row."""
    n = len(offsets) - 1
    _, _, rows, hashes = words(offsets, data, SPACED)
    count = np.bincount(rows, minlength=n)
    first = np.cumsum(count) - count + np.arange(1, n + 1)
    name = np.zeros(len(hashes) + n + 1, np.uint64)
    solid = np.zeros(len(name), bool)
    place = np.arange(len(hashes)) + rows + 1
    name[place], solid[place] = hashes, True
    name[~solid] = mixed(np.flatnonzero(~solid).astype(np.uint64) + BASE)
    return name, solid, first, count


def _starts(first: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    n = np.maximum(count - window + 1, 0)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def _sums(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash, and the inverse powers that make them independent of place."""
    sums = np.zeros(len(name) + 1, np.uint64)
    np.cumsum(name * powers(len(name)), out=sums[1:])
    return sums, powers(len(name), _INVERSE)


def _contexts(offsets: np.ndarray, data: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Stretches of windows that have the same symbol.

    name: of the symbol; key: of all words of the stretch and the symbol's place among them; n: 1,
    or more where that many neighbouring windows are equal to each other; row; p0, p1: first and
    last window of the stretch.
    """
    name, solid, first, count = _laid_out(offsets, data)
    at = _starts(first, count, window)
    stage, symbol = np.full(len(at), -1, np.int64), np.zeros(len(at), np.int64)
    anchor, place = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    stages = _stages(name, solid)
    for r in range(len(stages) - 1, -1, -1):
        if not len(left):
            break
        s, p = stages[r], at[left]
        begin = np.searchsorted(s.low, p)
        best, where = np.zeros(len(p), np.uint64), np.full(len(p), -1, np.int64)
        span = np.minimum(np.diff(s.start, append=s.start[-1] + 1), LONG).astype(np.uint64)
        rank = (s.name >> np.uint64(4)) | ((np.uint64(LONG) - span) << np.uint64(60))
        for k in range(CANDIDATES):
            i = np.minimum(begin + k, len(s.name) - 1)
            better = (s.high[i] <= p + window) & s.solid[i] & (s.low[i] >= p) & ((where < 0) | (rank[i] < best))
            where[better], best[better] = i[better], rank[i][better]
        found = where >= 0
        to = left[found]
        stage[to], symbol[to], anchor[to], place[to] = r, where[found], s.name[where[found]], s.start[where[found]]
        left = left[~found]
    cut = np.ones(len(at), bool)
    cut[1:] = (np.diff(at) != 1) | (np.diff(stage) != 0) | (np.diff(symbol) != 0)
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(at)) - 1
    p0, p1 = at[head], at[tail]
    sums, inverse = _sums(name)
    held = (sums[p1 + window] - sums[p0]) * inverse[p0]
    named = pairs_hash(anchor[head], stage[head].astype(np.uint64))
    key = pairs_hash(held, ((place[head] - p0) * (1 << 20) + (p1 - p0)).astype(np.uint64))
    row = np.searchsorted(first, p0, side="right") - 1
    again = np.zeros(len(p0), bool)
    again[1:] = (p0[1:] == p1[:-1] + 1) & (key[1:] == key[:-1]) & (named[1:] == named[:-1]) & (p0 == p1)[1:] & (p0 == p1)[:-1] & (row[1:] == row[:-1])
    head = np.flatnonzero(~again)
    tail = np.append(head[1:], len(again)) - 1
    return {"name": named[head], "key": key[head], "n": tail - head + 1, "row": row[head], "p0": p0[head] - first[row[head]], "p1": p1[tail] - first[row[head]]}


_CONTEXTS = "name long, key long, n int, rid long, p0 int, p1 int"


def _context_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rid = column(batch, "rid").to_numpy(zero_copy_only=False)
        for start, offsets, data in chunks(column(batch, "text")):
            c = _contexts(offsets, data, window)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c["name"].view(np.int64)),
                    pa.array(c["key"].view(np.int64)),
                    pa.array(c["n"].astype(np.int32)),
                    pa.array(rid[start + c["row"]]),
                    pa.array(c["p0"].astype(np.int32)),
                    pa.array(c["p1"].astype(np.int32)),
                ],
                names=["name", "key", "n", "rid", "p0", "p1"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Each window of the asked stretches: its hash joined with the symbol's name, row id, place, and whether its stretch occurs once."""
    for batch in batches:
        rids = column(batch, "rid").to_numpy(zero_copy_only=False)
        asked = column(batch, "asked")
        for start, offsets, data in chunks(column(batch, "text")):
            name, _, first, _ = _laid_out(offsets, data)
            sums, inverse = _sums(name)
            part = asked.slice(start, len(offsets) - 1)
            lists, flat = part.value_lengths().to_numpy(zero_copy_only=False), part.flatten()
            row = np.repeat(np.arange(len(lists)), lists)
            p0, p1 = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("p0", "p1"))
            n = p1 - p0 + 1
            of = np.repeat(np.arange(len(n)), n)
            p = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + p0[of]
            at = p + first[row[of]]
            held = (sums[at + window] - sums[at]) * inverse[at]
            symbol = flat.field("name").to_numpy(zero_copy_only=False).view(np.uint64)[of]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pairs_hash(held, symbol).view(np.int64)),
                    pa.array(rids[start + row[of]]),
                    pa.array(p.astype(np.int32)),
                    flat.field("lone").take(pa.array(of)),
                ],
                names=["held", "rid", "p", "lone"],
            )


def _kept_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = column(batch, "key")
        out: list[tuple[int, int, str]] = []
        texts, spans = column(batch, "text"), column(batch, "spans")
        for i in range(len(batch)):
            ws = (texts[i].as_py() or "").encode("utf-8").split()
            n = len(ws)
            if spans[i].is_valid and n:
                step = np.zeros(n + 1, np.int32)
                flat = spans[i].values
                np.add.at(step, flat.field("p0").to_numpy(), 1)
                np.add.at(step, flat.field("p1").to_numpy() + window, -1)
                ws = [w for w, gone in zip(ws, np.cumsum(step[:-1]).tolist(), strict=True) if not gone]
            out.append((n, n - len(ws), b" ".join(ws).decode("utf-8")))
            if len(out) == 2000 or i == len(batch) - 1:
                a, b, c = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([keys.slice(i + 1 - len(out), len(out)).cast(pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], names=["key", "n_words", "n_removed", "kept"])
                out = []


def remove_repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Each text without the words that a repeated window covers.

    Words are what blank, tab, line feed, vertical tab, form feed and return part, unchanged. A
    window is ``window`` consecutive words of one text; it is repeated if its words in this order
    start anywhere else, in the same text too. Windows are judged on the texts as they come, so no
    copy of a repeat stays. Gives ``key``, n_words, n_removed and kept, the words left joined by
    one blank.

    Null and empty texts, and those under ``window`` words, keep what they have. Null keys stay.
    Rows that repeat a key are texts of their own, each other's repeats if they are equal. The sort
    order of ties does not matter; an empty table gives an empty table; other columns are not read.

    Two windows count as equal if a 64-bit name of a symbol inside them and an independent 64-bit
    hash of all their words agree.
    """
    source = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("rid", F.xxhash64("key", "text"))
    contexts = written(source.select("rid", "text").mapInArrow(lambda it: _context_rows(it, window), _CONTEXTS), "op1-contexts")
    names = contexts.groupBy("name").agg(F.sum("n").alias("n"), F.min("key").alias("least"), F.max("key").alias("most"))
    names = written(names.where("n > 1").select("name", (F.col("least") != F.col("most")).alias("differ")), "op1-names")
    shared = written(contexts.join(names, "name"), "op1-shared")

    # Stretches that occur as a whole at least twice are repeated; of those that occur once, only
    # some windows may be, which the windows of one occurrence of each stretch decide.
    stretches = shared.where("differ").groupBy("name", "key").agg(F.sum("n").alias("n"), F.min(F.struct("rid", "p0", "p1")).alias("one"))
    stretches = written(stretches, "op1-stretches")
    twice = shared.where("not differ").select("rid", "p0", "p1")
    again = stretches.where("n > 1").select("name", "key")
    twice = twice.unionByName(shared.where("differ").join(again, ["name", "key"]).select("rid", "p0", "p1"))
    asked = stretches.select("one.rid", F.struct("name", "one.p0", "one.p1", (F.col("n") == 1).alias("lone")).alias("x")).groupBy("rid").agg(F.collect_list("x").alias("asked"))
    texts = source.select("rid", "text").join(asked.hint("shuffle_hash"), "rid")
    held = written(texts.dropDuplicates(["rid"]).mapInArrow(lambda it: _window_rows(it, window), "held long, rid long, p int, lone boolean"), "op1-windows")
    repeated = written(held.groupBy("held").agg(F.count("*").alias("n")).where("n > 1").select("held"), "op1-repeated")
    single = held.where("lone").join(repeated, "held").select("rid", F.col("p").alias("p0"), F.col("p").alias("p1"))

    spans = twice.unionByName(single).groupBy("rid").agg(F.collect_list(F.struct("p0", "p1")).alias("spans"))
    both = source.join(spans.hint("shuffle_hash"), "rid", "left").select("key", "text", "spans")
    kept = both.mapInArrow(lambda it: _kept_rows(it, window), "key long, n_words long, n_removed long, kept string")
    return kept.withColumnRenamed("key", key)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# Windows as arrays of words: for tables that one machine holds.
OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents),
w AS (
  SELECT r, p, md5(array_to_string(ws[p:p + 34], ' ')) AS h
  FROM t, unnest(range(1, len(ws) - 33)) AS u(p)),
d AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
g AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i FROM w JOIN d USING (h)),
k AS (SELECT r, list(i) AS gone FROM g GROUP BY r),
o AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
    CASE WHEN gone IS NULL THEN ws ELSE [ws[j] FOR j IN range(1, len(ws) + 1) IF NOT list_contains(gone, j)] END AS left_over
  FROM t LEFT JOIN k USING (r))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(left_over, ' '), '')) AS kept_sha256 FROM o
"""
