"""Benchmark decontamination with a generalised suffix automaton over the words of all test items."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brooklet.llm.common import ALNUM, chunks, column, row_ranges, words

WINDOW = 10
#: Bytes of item texts in one automaton; a larger benchmark is taken in blocks of items.
BLOCK_BYTES = 8 << 20
NUMBERED = "key long, n_words long, n_hit long, items array<long>, spans array<struct<first:int,last:int>>"


class Automaton:
    """Generalised suffix automaton of word sequences, with the items of each window.

    A window is ``window`` consecutive words of an item, or all words of an item that has fewer.
    ``items`` are (id, word hashes); items without words have no window, and items without an id
    hit words but are not named.
    """

    def __init__(self, items: list[tuple[int | None, list[int]]], window: int = WINDOW):
        self.window = window
        items = [x for x in items if x[1]]
        self.vocabulary = np.array(sorted({w for _, ws in items for w in ws}), np.uint64)
        self.code = {int(w): i for i, w in enumerate(self.vocabulary)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.code[w] for w in ws]) for item, ws in items]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        self.items: list[set[int]] = [set() for _ in self.next]
        self.short: list[list[tuple[int, int | None]]] = [[] for _ in self.next]
        for n, (item, ws) in enumerate(coded):
            state, seen = 0, set()
            for w in ws:
                up = state = self.next[state][w]
                while up > 0 and up not in seen:
                    seen.add(up)
                    if item is not None:
                        self.items[up].add(item)
                    up = self.link[up]
            if len(ws) < window:
                self.short[state].append((len(ws), item))
        self.least = min((min(window, len(ws)) for _, ws in coded), default=0)
        size = max(1, len(self.vocabulary))
        self.pairs = np.array(sorted({a * size + b for _, ws in coded for a, b in zip(ws, ws[1:], strict=False)}), np.int64)
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        self._window_state: dict[int, int] = {}
        self._shorts: dict[int, list[tuple[int, int | None]]] = {}

    def _extend(self, last: int, w: int) -> int:
        there = self.next[last].get(w)
        if there is not None:
            return there if self.length[there] == self.length[last] + 1 else self._clone(last, there, w)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            there = self.next[at][w]
            self.link[new] = there if self.length[there] == self.length[at] + 1 else self._clone(at, there, w)
        return new

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _clone(self, at: int, there: int, w: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[there]))
        self.link[copy], self.link[there] = self.link[there], copy
        while at >= 0 and self.next[at].get(w) == there:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def _of_window(self, state: int) -> int:
        found = self._window_state.get(state)
        if found is None:
            found = state
            while self.length[self.link[found]] >= self.window:
                found = self.link[found]
            self._window_state[state] = found
        return found

    def _of_shorts(self, state: int) -> list[tuple[int, int | None]]:
        found = self._shorts.get(state)
        if found is None:
            found, up = [], state
            while up > 0:
                found = found + self.short[up]
                up = self.link[up]
            self._shorts[state] = found
        return found

    def stream(self, codes: list[int], begin: int) -> Iterator[tuple[int, int, set[int]]]:
        """Occurrences of windows in a run of known words: first word, end, items."""
        state = matched = 0
        for at, w in enumerate(codes, begin + 1):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                matched += 1
            if matched >= self.window:
                yield at - self.window, at, self.items[self._of_window(state)]
            for n, item in self._of_shorts(state):
                if n <= matched:
                    yield at - n, at, set() if item is None else {item}

    def runs(self, hashes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Runs of words, within a row, whose neighbours are neighbours in an item too."""
        if not self.least:
            return
        known = np.flatnonzero(self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[known])
        at[at == len(self.vocabulary)] = 0
        right = self.vocabulary[at] == hashes[known]
        known, codes = known[right], at[right]
        if not len(known):
            return
        joined = (np.diff(known) == 1) & (rows[known[1:]] == rows[known[:-1]])
        if self.least > 1 and len(self.pairs):
            pair = codes[:-1] * len(self.vocabulary) + codes[1:]
            place = np.searchsorted(self.pairs, pair)
            place[place == len(self.pairs)] = 0
            joined &= self.pairs[place] == pair
        cuts = np.concatenate([[0], np.flatnonzero(~joined) + 1, [len(known)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a >= self.least:
                yield int(known[a]), codes[a:b].tolist()


def _scan(batches: Iterator[pa.RecordBatch], automaton: Automaton, cut: bool) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    for batch in batches:
        texts = column(batch, "text")
        carried = [c for c in batch.schema.names if c != "text"]
        names = [*carried, "n_words", "n_hit", "items", "spans", *(["kept"] if cut else [])]
        for first, offsets, data in chunks(texts):
            n = len(offsets) - 1
            starts, ends, rows, hashes = words(offsets, data, ALNUM, fold=True)
            bounds = row_ranges(rows, n)
            step = np.zeros(len(starts) + 1, np.int32)
            items: dict[int, set[int]] = {}
            for begin, codes in automaton.runs(hashes, rows):
                for a, b, found in automaton.stream(codes, begin):
                    step[a] += 1
                    step[b] -= 1
                    items.setdefault(int(rows[begin]), set()).update(found)
            hit = np.cumsum(step[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            spans: list[list[dict]] = [[] for _ in range(n)]
            kept: list[str | None] = texts.slice(first, n).to_pylist() if cut else []
            for row in items:
                a, b = bounds[row], bounds[row + 1]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], hit[a:b], [False]]).astype(np.int8)))
                spans[row] = [{"first": int(x), "last": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)]
                if cut:
                    parts, at = [], int(offsets[row])
                    for x, y in zip(edge[::2], edge[1::2], strict=True):
                        parts.append(data[at : starts[a + x]].tobytes())
                        at = int(ends[a + y - 1])
                    parts.append(data[at : offsets[row + 1]].tobytes())
                    kept[row] = b"".join(parts).decode("utf-8")
            out = [
                *(column(batch, c).slice(first, n) for c in carried),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(total[bounds[1:]] - total[bounds[:-1]], pa.int64()),
                pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.int64())),
                pa.array(spans, spans_type),
            ]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(kept, pa.string())] if cut else []), names=names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = WINDOW, cut: bool = False, carry: Sequence[str] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words of each text that lie inside an occurrence of a window of a test item.

    Words are runs of ASCII letters and digits and of all other characters that are not ASCII, with
    A-Z as a-z. A window is ``window`` consecutive words of an item, or the whole item where it has
    fewer words. Gives one row per document: ``key``, n_words, n_hit, items (ids, ascending) and
    spans of hit words (numbers of the first word and of the one after the last); with ``cut``
    also kept, the text without the spans. Every document streams through the automaton of the
    items, whatever it weighs; a benchmark over ``block_bytes`` is taken in blocks of items, each
    with an automaton within that bound, and the blocks' spans are merged per document.

    Null texts have no words; a null key stays; repeated rows give a row each; items that repeat an
    id count once; a null or wordless item matches nothing; an empty benchmark leaves all as it is.
    Other columns are not read, but those that ``carry`` names come along.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_bytes))
    source = docs.select(F.col(key).cast("long").alias(key), *carry, F.col("text").cast("string").alias("text"))
    schema = StructType([*source.schema.fields[:-1], *StructType.fromDDL(NUMBERED).fields[1:], *([StructField("kept", StringType())] if cut else [])])

    def automaton(block: int) -> Automaton:
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else bench
        rows = part.collect()  # within block_bytes
        found: list[tuple[int | None, list[int]]] = []
        for row in rows:
            for _, offsets, data in chunks(pa.array([row["text"]], pa.string())):
                found.append((row["item_id"], [int(h) for h in words(offsets, data, ALNUM, fold=True)[3]]))
        return Automaton(found, window)

    if blocks == 1:
        shared = spark.sparkContext.broadcast(automaton(0))
        return source.mapInArrow(lambda it: _scan(it, shared.value, cut), schema)

    numbered = source.withColumn("_part", F.xxhash64(F.col(key), F.col("text")))
    parts = []
    for block in range(blocks):
        shared = spark.sparkContext.broadcast(automaton(block))
        one = numbered.select(F.col("_part").alias("key"), "text").mapInArrow(lambda it, shared=shared: _scan(it, shared.value, False), NUMBERED)
        parts.append(one.where("n_hit > 0").select(F.col("key").alias("_part"), "items", "spans"))
    found = reduce(DataFrame.unionByName, parts).groupBy("_part")
    found = found.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"), F.flatten(F.collect_list("spans")).alias("_spans"))
    both = numbered.join(found, "_part", "left").drop("_part").select(key, *carry, "_items", "_spans", "text")
    return both.mapInArrow(lambda it: _merge(it, cut), schema)


def _merge(batches: Iterator[pa.RecordBatch], cut: bool) -> Iterator[pa.RecordBatch]:
    """Joins the spans that the blocks of a large benchmark have found in a text."""
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    for batch in batches:
        texts, items, spans = (column(batch, c).to_pylist() for c in ("text", "_items", "_spans"))
        carried = [c for c in batch.schema.names if c not in ("text", "_items", "_spans")]
        for start, offsets, data in chunks(column(batch, "text")):
            n = len(offsets) - 1
            starts, ends, of, _ = words(offsets, data, ALNUM, fold=True)
            bounds = row_ranges(of, n)
            hits, joined, kept = [], [], []
            for i in range(n):
                a, b = bounds[i], bounds[i + 1]
                hit = np.zeros(b - a + 2, np.int8)
                for span in spans[start + i] or ():
                    hit[span["first"] + 1 : span["last"] + 1] = 1
                edge = np.flatnonzero(np.diff(hit))
                hits.append(int(hit.sum()))
                joined.append([{"first": int(p), "last": int(q)} for p, q in zip(edge[::2], edge[1::2], strict=True)])
                out, at = [], int(offsets[i])
                for p, q in zip(edge[::2], edge[1::2], strict=True):
                    out.append(data[at : starts[a + p]].tobytes())
                    at = int(ends[a + q - 1])
                out.append(data[at : offsets[i + 1]].tobytes())
                kept.append(None if texts[start + i] is None else b"".join(out).decode("utf-8"))
            rows = [pa.array(np.diff(bounds), pa.int64()), pa.array(hits, pa.int64()), pa.array([x or [] for x in items[start : start + n]], pa.list_(pa.int64())), pa.array(joined, spans_type)]
            names = [*carried, "n_words", "n_hit", "items", "spans", *(["kept"] if cut else [])]
            yield pa.RecordBatch.from_arrays([*(column(batch, c).slice(start, n) for c in carried), *rows, *([pa.array(kept, pa.string())] if cut else [])], names=names)


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    named = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
