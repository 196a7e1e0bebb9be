"""Keyed tables in plain Parquet: an upsert log, snapshots of it, and one row per key.

Folders of a table::

    commits/<version>.json                                      what the table consists of
    log/folder=<f>/rejected=<bool>                              micro-batches, as they came
    snapshot/snapshot=<id>/month=<m>/key_bucket=<b>             folded log, one row per key
    rejects/<id>                                                rejected rows of folded batches

A commit names the attempts at micro-batches that count and the snapshot folders that are current,
each with its rows and the bounds of its range column, so a reader lists the commits and the folders
that it needs, and nothing else. All batches since the last fold are in one folder.

A run is a row of batches by one writer: a streaming query, known by the id that its checkpoint
keeps, or a load. A query that starts over with an empty checkpoint has a new id and so begins a
new run, which comes after all that is there. One query writes at a time; folds may run beside it.

A micro-batch costs no shuffle, and running it again changes nothing: the commit names its last
attempt only. Readers fold the log, and take from the base snapshot the rows that the log does not
replace: the base is scanned but not shuffled while the log stays small.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.latest import earliest, latest
from ..schemas import BOOL, FIRST, INT, LONG, TEXT, TableSpec, struct
from .commits import Batch, Commit, CommitLog, Piece
from .files import children, remove

RUN, BATCH, REJECTED, ATTEMPT, FOLDER = "run", "batch_id", "rejected", "attempt", "folder"
SNAPSHOT, MONTH, BUCKET = "snapshot", "month", "key_bucket"
LOG_COLUMNS = struct(run=INT, batch_id=LONG, attempt=TEXT, folder=TEXT, rejected=BOOL)
SNAPSHOT_COLUMNS = struct(snapshot=TEXT, month=TEXT, key_bucket=INT)
DIRECT = "direct"
#: Versions whose folders a clean-up leaves alone, for readers and writers that began with them.
KEPT_VERSIONS = 100
Bounds = tuple[datetime | None, datetime | None]


def read_if_present(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet"
) -> DataFrame | None:
    """The files under a path, or None where there is no such path yet."""
    if children(spark, path) is None:
        return None
    return spark.read.format(file_format).schema(schema).load(path)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame that the optimizer knows to be empty."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def _micros(moment: datetime | None) -> int | None:
    """Microseconds since the epoch of a moment; one without a zone is in the driver's, as in a literal."""
    if moment is None:
        return None
    return int(moment.replace(microsecond=0).timestamp()) * 1_000_000 + moment.microsecond


class UpsertTable:
    """A keyed table under one path; one streaming query writes it."""

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self._log = CommitLog(spark, f"{self.path}/commits")

    def current_commit(self) -> Commit:
        return self._log.current()

    # -- writing

    def write_batch(self, batch: DataFrame, batch_id: int, writer: str = DIRECT) -> Commit:
        """Puts a micro-batch into the log. Rows without a whole key are kept apart as rejects.

        A batch that its writer has written before is replaced, unless another writer came between.
        Counts and bounds come from the write itself.
        """
        before = self.current_commit()
        folder, attempt = before.folder or uuid.uuid4().hex, uuid.uuid4().hex
        no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in self.spec.key))
        run = before.run if writer == before.writer else before.run + 1
        place = [F.lit(run).alias(RUN), F.lit(batch_id).cast("bigint").alias(BATCH), F.lit(attempt).alias(ATTEMPT)]
        rows = batch.select(*self._typed_columns(batch), *place, no_key.alias(REJECTED))
        seen = Observation()
        low, high = self._bounds(f"NOT {REJECTED}")
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(REJECTED).alias("rejected"), low.alias("low"), high.alias("high"))
        rows.write.mode("append").partitionBy(REJECTED).parquet(f"{self.path}/log/{FOLDER}={folder}")
        found = seen.get

        def made(now: Commit) -> Commit:
            new = Batch(run, batch_id, writer, attempt, folder, found["rows"], found["rejected"], found["low"], found["high"])
            old = [b for b in now.batches if b.position == new.position]
            others = [b for b in now.batches if b.position != new.position]
            return replace(
                now,
                batches=tuple(sorted([*others, new], key=lambda b: b.position)),
                folder=now.folder or folder,
                run=run,
                writer=writer,
                written=now.written + new.rows - sum(b.rows for b in old),
                rejected=now.rejected + new.rejected - sum(b.rejected for b in old),
            )

        return self._log.change(made)

    def load(self, rows: DataFrame) -> Commit:
        """Puts a static frame into the log, as a run of its own."""
        return self.write_batch(rows, 0, f"load-{uuid.uuid4().hex}")

    def _typed_columns(self, df: DataFrame) -> list[Column]:
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema]

    def _bounds(self, where: str = "true") -> tuple[Column, Column]:
        if self.spec.range_column is None:
            nothing = F.max(F.lit(None).cast("bigint"))
            return nothing, nothing
        moment = F.unix_micros(F.when(F.expr(where), F.col(self.spec.range_column)).cast("timestamp"))
        return F.min(moment), F.max(moment)

    # -- reading

    def read(
        self,
        months: Sequence[str] | None = None,
        keys: Mapping[str, Any] | None = None,
        between: Bounds | None = None,
        version: int | None = None,
    ) -> DataFrame:
        """One row of each key: the last, or the first where the table keeps that.

        ``months`` (``yyyy-MM`` of the range column), ``keys`` (values of key columns) and
        ``between`` (first and last moment of the range column, either may be None) read only the
        folders they need. ``version`` reads the table as it was, by the number of a commit.
        """
        commit = self.current_commit() if version is None else self._log.at(version)
        chosen = self._key_conditions(keys)
        bucket = self._bucket_of(keys)
        if (months is not None or between is not None) and self.spec.range_column is None:
            raise ValueError(f"{self.spec.name} has no months")
        if months is not None:
            chosen.append(F.col(MONTH).isin(*months))
        low, high = between or (None, None)
        if low is not None:
            chosen.append(F.col(self.spec.range_column) >= F.lit(low))
        if high is not None:
            chosen.append(F.col(self.spec.range_column) <= F.lit(high))

        def wanted(part: Piece | Batch) -> bool:
            if part.rows == 0:
                return False
            if isinstance(part, Piece) and (months is not None and part.month not in months or bucket is not None and part.bucket != bucket):
                return False
            if part.low is None:
                return self.spec.range_column is None
            return (low is None or part.high >= _micros(low)) and (high is None or part.low <= _micros(high))

        layers = tuple(tuple(filter(wanted, layer)) for layer in commit.layers)
        return self._merged(layers, [b for b in commit.batches if wanted(b)], chosen)

    def _merged(self, layers: Sequence[Sequence[Piece]], batches: Sequence[Batch], chosen: Sequence[Column] = ()) -> DataFrame:
        """One row per key of layers and batches, where the conditions hold."""

        def narrowed(rows: DataFrame) -> DataFrame:
            return reduce(DataFrame.where, chosen, rows)

        tail = self._fold(narrowed(self._versions(layers[1:], batches)))
        if not layers or not layers[0]:
            return tail
        key = list(self.spec.key)
        base = narrowed(self._pieces(layers[0])).select(*self._names)
        if self.spec.keep == FIRST:
            # The keys that the base has among the new ones: the new ones are few, so the base stays where it is.
            there = base.select(*key).join(tail.select(*key), key, "left_semi")
            return base.unionByName(tail.join(there, key, "left_anti").select(*self._names))
        untouched = base.join(tail.select(*key), key, "left_anti")
        return untouched.select(*self._names).unionByName(tail)

    def num_rows(self) -> int | None:
        """How many keys the table has, as its commit tells without a look at the rows; None if only a count can tell."""
        commit = self.current_commit()
        if len(commit.layers) > 1 or any(b.rows > b.rejected for b in commit.batches):
            return None
        return sum(p.rows for layer in commit.layers for p in layer)

    def rejects(self) -> DataFrame:
        """Rows that came without a whole key."""
        commit = self.current_commit()
        rows = self._rows_of([b for b in commit.batches if b.rejected], rejected=True).select(*self._names)
        if not commit.rejects:
            return rows
        folded = self.spark.read.schema(self.spec.schema).parquet(*[f"{self.path}/rejects/{r}" for r in commit.rejects])
        return folded.unionByName(rows)

    def register_view(self, name: str | None = None) -> DataFrame:
        """The table as a frame and as a temporary view."""
        frame = self.read()
        frame.createOrReplaceTempView(name or self.spec.name)
        return frame

    @property
    def _names(self) -> list[str]:
        return self.spec.schema.fieldNames()

    def _rows_of(self, batches: Sequence[Batch], rejected: bool = False) -> DataFrame:
        """Rows of batches in the log, with their run and number; leftovers of other attempts stay out."""
        schema = StructType(self.spec.schema.fields + LOG_COLUMNS.fields)
        if not batches:
            return no_rows(self.spark, schema)
        folders = sorted({f"{self.path}/log/{FOLDER}={b.folder}/{REJECTED}={str(rejected).lower()}" for b in batches})
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/log").parquet(*folders)
        # As many names as the commit has batches; a filter leaves Spark its estimate of the size.
        live = ", ".join(f"'{b.attempt}'" for b in batches)
        return rows.where(f"{ATTEMPT} IN ({live})")

    def _pieces(self, pieces: Iterable[Piece]) -> DataFrame:
        """Rows of snapshot folders; no other folder is looked into."""
        folders = [f"{self.path}/snapshot/{SNAPSHOT}={p.snapshot}/{MONTH}={p.month}/{BUCKET}={p.bucket}" for p in pieces]
        schema = StructType(self.spec.schema.fields + SNAPSHOT_COLUMNS.fields)
        if not folders:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/snapshot").parquet(*folders)

    def _versions(self, layers: Sequence[Sequence[Piece]], batches: Sequence[Batch]) -> DataFrame:
        """All versions in the layers, from old to new, and in the log."""
        parts = [self._with_layout(self._rows_of([b for b in batches if b.rows > b.rejected]).drop(ATTEMPT, FOLDER, REJECTED))]
        for age, layer in enumerate(layers):
            # Layers are older than any batch in the log, whose runs start from 0.
            place = {RUN: F.lit(age - len(layers)), BATCH: F.lit(0).cast("bigint")}
            parts.append(self._pieces(layer).drop(SNAPSHOT).withColumns(place))
        return reduce(DataFrame.unionByName, parts)

    def _fold(self, versions: DataFrame) -> DataFrame:
        rows = versions.select(*self._names, RUN, BATCH)
        order = [RUN, BATCH, *self.spec.order_by]
        fold = earliest if self.spec.keep == FIRST else latest
        return fold(rows, list(self.spec.key), order).select(*self._names)

    def _with_layout(self, rows: DataFrame) -> DataFrame:
        month = F.lit("all")
        if self.spec.range_column is not None:
            # Months are those of the session's time zone, which must be the same in all jobs.
            month = F.date_format(self.spec.range_column, "yyyy-MM")
        hashed = F.xxhash64(*[F.col(c) for c in self.spec.bucket_columns])
        return rows.withColumns(
            {MONTH: month, BUCKET: F.pmod(hashed, F.lit(self.spec.buckets)).cast("int")}
        )

    def _key_conditions(self, keys: Mapping[str, Any] | None) -> list[Column]:
        if not keys:
            return []
        if not set(keys) <= set(self.spec.key):
            raise ValueError(f"{self.spec.name}: keys are {self.spec.key}")
        return [F.col(k) == self._typed(k, v) for k, v in keys.items()]

    def _typed(self, column: str, value: Any) -> Column:
        return F.lit(value).cast(self.spec.schema[column].dataType)

    def _bucket_of(self, keys: Mapping[str, Any] | None) -> int | None:
        """The bucket that key values determine, if they do."""
        if not keys or not set(self.spec.bucket_columns) <= set(keys):
            return None
        hashed = F.xxhash64(*[self._typed(c, keys[c]) for c in self.spec.bucket_columns])
        return self.spark.range(1).select(F.pmod(hashed, F.lit(self.spec.buckets))).first()[0]

    # -- folding the log

    def compact(self, full: bool = False, settled: bool = False) -> Commit:
        """Folds the log into a snapshot and makes it current.

        The usual run folds only what came since the last one, into a layer. A ``full`` run then
        merges the layers into the first: it reads and writes only the months and buckets in
        which a later layer has rows. The newest batch stays in the log, because a restarted query
        may write it again, unless the table is ``settled``: its query has ended for good. A query
        may go on writing meanwhile, but only one compaction runs at a time. ``clean_up`` removes
        what no current version needs.
        """
        commit = self.current_commit()
        batches = commit.batches if settled else commit.batches[:-1]
        if batches:
            commit = self._fold_batches(batches)
        return self._merge_layers(commit) if full and len(commit.layers) > 1 else commit

    def _fold_batches(self, batches: Sequence[Batch]) -> Commit:
        layer = self._write_snapshot(self._fold(self._versions((), batches))) if any(b.rows > b.rejected for b in batches) else ()
        rejects = ()
        if any(b.rejected for b in batches):
            rejects = (uuid.uuid4().hex,)
            self._rows_of([b for b in batches if b.rejected], rejected=True).select(*self._names).write.parquet(f"{self.path}/rejects/{rejects[0]}")
        folded = {b.attempt for b in batches}

        def made(now: Commit) -> Commit:
            return replace(
                now,
                layers=(*now.layers, layer) if layer else now.layers,
                batches=tuple(b for b in now.batches if b.attempt not in folded),
                folder=uuid.uuid4().hex,
                rejects=(*now.rejects, *rejects),
            )

        return self._log.change(made)

    def _merge_layers(self, commit: Commit) -> Commit:
        touched = {p.place for layer in commit.layers[1:] for p in layer}
        layers = [[p for p in layer if p.place in touched] for layer in commit.layers]
        merged = self._write_snapshot(self._merged(layers, ()))
        kept = tuple(p for p in commit.layers[0] if p.place not in touched)
        return self._log.change(lambda now: replace(now, layers=((*kept, *merged), *now.layers[len(commit.layers) :])))

    def _write_snapshot(self, rows: DataFrame) -> tuple[Piece, ...]:
        name = uuid.uuid4().hex
        target = f"{self.path}/snapshot/{SNAPSHOT}={name}"
        # Few files per folder, and big folders split over several tasks.
        laid_out = self._with_layout(rows).hint("rebalance", MONTH, BUCKET)
        laid_out.write.partitionBy(MONTH, BUCKET).parquet(target)
        low, high = self._bounds()
        schema = StructType(self.spec.schema.fields + SNAPSHOT_COLUMNS.fields[1:])
        found = self.spark.read.schema(schema).parquet(target).groupBy(MONTH, BUCKET).agg(F.count(F.lit(1)).alias("n"), low.alias("low"), high.alias("high"))
        # One row per month and bucket.
        return tuple(Piece(name, r[MONTH], r[BUCKET], r["n"], r["low"], r["high"]) for r in found.orderBy(MONTH, BUCKET).collect())

    def obsolete(self, keep_versions: int = 1) -> list[str]:
        """Folders that none of the newest versions needs."""
        versions = self._log.versions()[-keep_versions:]
        needed = set().union(*(self._log.at(v).folders() for v in versions))
        there = [f"{kind}/{name}" for kind in ("log", "snapshot", "rejects") for name in children(self.spark, f"{self.path}/{kind}") or []]
        return sorted(f"{self.path}/{folder}" for folder in there if folder not in needed and not folder.endswith("_SUCCESS"))

    def clean_up(self, keep_versions: int = KEPT_VERSIONS) -> list[str]:
        """Removes old versions, and the folders that only they need; not while a compaction runs.

        Readers and writers that began with one of the newest ``keep_versions`` versions are not disturbed.
        """
        self._log.forget(keep_versions)
        gone = self.obsolete(keep_versions)
        for folder in gone:
            remove(self.spark, folder)
        return gone

    # -- moving old months away

    def offload(self, before: str, target: str, settled: bool = False) -> Commit:
        """Moves the months before ``before`` to plain Parquet, in a folder per offload and month.

        Only those months are read, and nothing is rewritten: the commit no longer names their folders.
        Rows that are still in the log stay, as do rows that come later for an old month; the
        next offload moves them, and its folder has the greater ``version``.
        """
        if self.spec.range_column is None:
            raise ValueError(f"{self.spec.name} has no months")
        commit = self.compact(settled=settled)
        old = self._merged([[p for p in layer if p.month < before] for layer in commit.layers], ())
        # The folder of an offload that broke off before its commit is written anew.
        laid_out = self._with_layout(old).drop(BUCKET).hint("rebalance", MONTH)
        laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            MONTH
        ).parquet(f"{target}/version={commit.version + 1}")
        moved = {p for layer in commit.layers for p in layer if p.month < before}
        return self._log.change(lambda now: replace(now, layers=tuple(tuple(p for p in layer if p not in moved) for layer in now.layers)))


def with_retries(
    write: Callable[[], None], retries: int, before_retry: Callable[[], None] | None = None
) -> None:
    """Runs ``write`` until it succeeds, at most ``retries`` times more; then raises its error."""
    if retries < 0:
        raise ValueError("retries must be non-negative")
    left = retries
    while True:
        try:
            return write()
        except Exception:
            if left == 0:
                raise
            left -= 1
            if before_retry is not None:
                before_retry()
