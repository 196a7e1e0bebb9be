"""Product codes for vectors: parts of a vector as indexes into codebooks that are fitted by exact integer Lloyd rounds.

Active-entry Lloyd: every part keeps the index of its nearest entry and the exact distance to it. After
a round, a part whose entry stayed where it was is compared only with the entries that moved; one
whose entry moved is compared with all. Ties go to the lower index in both, so the result is that of
a plain round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brooklet.llm.common import column, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Largest size of a scaled component: squares of differences, and sums of them, stay exact in 64 bits.
LARGEST = 1 << 24
#: Vectors that one vectorised step compares with the entries.
STEP = 4096

_STATE = "vec_id long, label string, ints array<int>, codes binary, distances array<long>"


@dataclass(frozen=True)
class Books:
    """Codebooks as an array of parts, entries and components, and which entries the last round moved."""

    entries: np.ndarray
    moved: np.ndarray

    def updated(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Books:
        """Entries replaced by the floored means of their parts; those without parts stay."""
        after = self.entries.copy()
        for (part, entry), (n, total) in sums.items():
            after[part, entry] = [t // n for t in total]
        return Books(after, (after != self.entries).any(axis=2))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _nearest(ints: np.ndarray, entries: np.ndarray, indexes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index among ``indexes`` and squared distance of each part's nearest entry; the first of equal ones."""
    differ = ints[:, None, :] - entries[indexes][None, :, :]
    squares = np.einsum("nej,nej->ne", differ, differ)
    at = squares.argmin(axis=1)
    return indexes[at], squares[np.arange(len(ints)), at]


def assigned(ints: np.ndarray, books: Books, codes: np.ndarray | None = None, distances: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries of the parts (vectors x parts x components) and the distances to them.

    ``codes`` and ``distances`` are those from before the books' last update, or None at the start.
    """
    n, parts, _ = ints.shape
    out, far = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
    for p in range(parts):
        everything = np.arange(books.entries.shape[1])
        active = np.flatnonzero(books.moved[p])
        for first in range(0, n, STEP):
            rows = slice(first, first + STEP)
            part = ints[rows, p, :]
            if codes is None:
                out[rows, p], far[rows, p] = _nearest(part, books.entries[p], everything)
                continue
            code, distance = codes[rows, p].copy(), distances[rows, p].copy()
            again = books.moved[p][code]
            if again.any():
                code[again], distance[again] = _nearest(part[again], books.entries[p], everything)
            if len(active) and not again.all():
                kept = np.flatnonzero(~again)
                found, near = _nearest(part[kept], books.entries[p], active)
                better = (near < distance[kept]) | ((near == distance[kept]) & (found < code[kept]))
                code[kept[better]], distance[kept[better]] = found[better], near[better]
            out[rows, p], far[rows, p] = code, distance
    return out, far


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scaled integer components of the whole vectors; other rows go."""
    for batch in batches:
        vectors = column(batch, "vector").cast(pa.list_(pa.float64()))
        lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = vectors.flatten()
        sound = np.isfinite(values.fill_null(np.nan).to_numpy(zero_copy_only=False))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        whole = np.diff(np.concatenate([[0], np.cumsum(~sound)])[bounds]) == 0
        whole &= (lengths > 0) & (lengths % PARTS == 0)
        scaled = np.floor(SCALE * np.where(sound, values.fill_null(0).to_numpy(zero_copy_only=False), 0))[np.repeat(whole, lengths)]
        if len(scaled) and np.abs(scaled).max() > LARGEST:
            raise ValueError(f"components beyond {LARGEST // SCALE} are not supported")
        kept = pa.array(np.flatnonzero(whole))
        offsets = np.concatenate([[0], np.cumsum(lengths[whole])]).astype(np.int32)
        ints = pa.ListArray.from_arrays(pa.array(offsets), pa.array(scaled.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([column(batch, "vec_id").take(kept), column(batch, "label").take(kept), ints], names=["vec_id", "label", "ints"])


def _unpacked(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return column(batch, "ints").flatten().to_numpy().astype(np.int64).reshape(-1, PARTS, width)


def _assign(batches: Iterator[pa.RecordBatch], books: Books) -> Iterator[pa.RecordBatch]:
    """The rows with codes and distances brought up to date."""
    width = books.entries.shape[2]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        codes = distances = None
        if "codes" in batch.schema.names:
            codes = np.frombuffer(b"".join(column(batch, "codes").to_pylist()), np.uint8).reshape(n, PARTS).astype(np.int64)
            distances = column(batch, "distances").flatten().to_numpy().reshape(n, PARTS)
        codes, distances = assigned(_unpacked(batch, width), books, codes, distances)
        packed = codes.astype(np.uint8)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * PARTS + 1, PARTS, dtype=np.int32)), pa.array(distances.ravel()))
        yield pa.RecordBatch.from_arrays(
            [column(batch, "vec_id"), column(batch, "label"), column(batch, "ints"), pa.array([row.tobytes() for row in packed], pa.binary()), lists],
            names=["vec_id", "label", "ints", "codes", "distances"],
        )


def _sums(batches: Iterator[pa.RecordBatch], shape: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    """Per part and entry: assigned parts of this task, and sums of their components, one row each."""
    n, total = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
    for batch in batches:
        ints = _unpacked(batch, shape[2])
        codes = np.frombuffer(b"".join(column(batch, "codes").to_pylist()), np.uint8).reshape(len(ints), PARTS).astype(np.int64)
        for p in range(PARTS):
            n[p] += np.bincount(codes[:, p], minlength=shape[1])
            order = np.argsort(codes[:, p], kind="stable")
            first = np.flatnonzero(np.diff(codes[order, p], prepend=-1))
            if len(first):
                total[p, codes[order, p][first]] += np.add.reduceat(ints[order, p, :], first, axis=0)
    part, entry, place = (a.ravel() for a in np.indices(shape))
    used = n[part, entry] > 0
    columns = [pa.array(x[used]) for x in (part, entry, place, n[part, entry], total.ravel())]
    yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "n", "total"])


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Codes of all whole vectors, under codebooks that are fitted to all of them.

    A component x counts as floor(256 * x); vectors are cut into 16 equal parts, and each part position
    has a codebook of 64 entries, at first those parts of the vectors with the smallest keys. Each
    of two rounds assigns every part to the nearest entry (squared Euclidean distance, ties to the
    lower index) and replaces entries by the floored means of their parts; unused ones stay. A last
    assignment gives the codes. All of it is exact in integers.

    Gives one row per vector: ``key``, code (two hex digits a part), error (squared distances, summed),
    label_error (errors summed over equal labels) and codebooks_sha256 (of all entries' components in
    decimal digits, by part, entry and place, joined by commas).

    Vectors that are null, empty, hold null or non-finite components or are not 16 equal parts have no
    row, nor have those of another length than the vector with the smallest key. Components must lie
    within 2**16, else an error says so. Null keys come last in the order; of equal keys the smaller
    vector comes first, and equal rows are vectors of their own. Null labels belong together. With
    fewer than 64 vectors the codebooks have an entry for each. An empty table gives an empty table;
    other columns are not read.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = written(source.mapInArrow(_integers, "vec_id long, label string, ints array<int>"), "op13-integers")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints")
    lowest = first.select(F.size("ints").alias("n")).first()
    if lowest is None:
        return spark.createDataFrame([], f"`{key}` long, code string, error long, label_error long, codebooks_sha256 string")
    # At most 64 vectors, whatever the table's size.
    rows = rows.where(F.size("ints") == lowest["n"])
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(ENTRIES).collect()
    entries = np.array([r["ints"] for r in start], np.int64).reshape(len(start), PARTS, -1).transpose(1, 0, 2)
    books = Books(entries, np.ones(entries.shape[:2], bool))

    def brought_up_to_date(rows: DataFrame, books: Books) -> DataFrame:
        return rows.mapInArrow(lambda it: _assign(it, books), _STATE)

    for _ in range(ROUNDS):
        rows = written(brought_up_to_date(rows, books), "op13-state")
        shape = books.entries.shape
        sums = rows.select("ints", "codes").mapInArrow(lambda it: _sums(it, shape), "part long, entry long, place long, n long, total long")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        # One row per component of an entry, whatever the table's size.
        sums = sums.groupBy("part", "entry").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "total"))).alias("totals")).collect()
        books = books.updated({(r["part"], r["entry"]): (r["n"], [t["total"] for t in r["totals"]]) for r in sums})

    final = brought_up_to_date(rows, books)
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d)
    final = written(final.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), error.alias("error")), "op13-codes")
    per_label = final.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = final.join(per_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("vec_id").alias(key), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_vector_code_compression(spark, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql_round(k: int, last: bool) -> str:
    """SQL of an assignment to the entries b<k> and, unless it is the last, of the entries that follow."""
    assign = f"""a{k} AS (
  SELECT r, p, any_value(v.x) AS x, min(list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {ENTRIES} + b.e) AS best
  FROM v JOIN b{k} AS b USING (p) GROUP BY r, p),"""
    if last:
        return assign
    return f"""{assign}
m{k} AS (
  SELECT p, best % {ENTRIES} AS e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS c
  FROM a{k}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY p, best % {ENTRIES}, i),
n{k} AS (SELECT p, e, list(c ORDER BY i) AS x FROM m{k} GROUP BY p, e),
b{k + 1} AS (SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM b{k} AS b LEFT JOIN n{k} AS n ON n.p = b.p AND n.e = b.e),"""


OP13_SQL = f"""
WITH
k AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS ints
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
o AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, ints) - 1 AS r FROM k),
v AS (SELECT r, p, ints[p * len(ints) // {PARTS} + 1:(p + 1) * len(ints) // {PARTS}] AS x FROM o, unnest(range({PARTS})) AS u(p)),
b0 AS (SELECT p, r AS e, x FROM v WHERE r < {ENTRIES}),
{''.join(_sql_round(k, k == ROUNDS) for k in range(ROUNDS + 1))}
s AS (SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code, sum(best // {ENTRIES})::BIGINT AS error FROM a{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
FROM o JOIN s USING (r)
"""
