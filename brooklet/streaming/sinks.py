"""Sinks: how a named output is written by a streaming query."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import TimestampNTZType, TimestampType

from .live import Clock, Moment, moment_of
from .upsert import DIRECT, KEPT_VERSIONS, UpsertTable, with_retries

# The reference's formats, which keep whole seconds and milliseconds only; the default keeps microseconds.
TRANSACTION_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CSV_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
_WHOLE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Maintenance:
    """Folds a table after every ``compact_every`` micro-batches, merges all layers at every
    ``merge_every``-th fold, and then removes what only versions before the newest ``keep_versions`` need.
    """

    compact_every: int = 200
    merge_every: int = 10
    keep_versions: int = KEPT_VERSIONS

    def after(self, table: UpsertTable, batch_id: int) -> None:
        folds, rest = divmod(batch_id + 1, self.compact_every)
        if rest == 0:
            table.compact(full=folds % self.merge_every == 0)
            table.clean_up(self.keep_versions)


@dataclass(frozen=True)
class Sink:
    """A name and the way to set up a writer for a frame and a checkpoint folder."""

    name: str
    writer: Callable[[DataFrame, str], DataStreamWriter]


def checkpoint_path(base: str, name: str) -> str:
    """One folder per output below a base of the user's, so that a new process finds it again."""
    return f"{base.rstrip('/')}/{name}"


def _trigger(writer: DataStreamWriter, seconds: float | None) -> DataStreamWriter:
    return writer if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that a micro-batch belongs to; its checkpoint keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def upsert_sink(
    table: UpsertTable,
    name: str | None = None,
    retries: int = 1,
    trigger_seconds: float | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    before_retry: Callable[[], None] | None = None,
    output_mode: str = "update",
    join: Callable[[DataFrame, Moment], DataFrame] | None = None,
    live: Mapping[str, UpsertTable] | None = None,
    clock: Clock | None = None,
    maintenance: Maintenance | None = None,
) -> Sink:
    """Writes micro-batches to a keyed table, each of them again after an error.

    ``prepare`` is applied to every micro-batch as a static frame. ``join`` comes before it and also gets
    the micro-batch's moment: a time, and the rows of the ``live`` tables as they are when it is
    first tried. A second try has the same moment, as the query's checkpoint notes it.
    ``maintenance`` folds the table after every so many micro-batches.
    """
    if output_mode != "update":
        raise ValueError(f"a keyed table takes output mode update, not {output_mode}")
    if retries < 0:
        raise ValueError("retries must be non-negative")
    if live and join is None:
        raise ValueError("live tables need a function that joins them")

    def writer(df: DataFrame, checkpoint: str) -> DataStreamWriter:
        def write(batch: DataFrame, batch_id: int) -> None:
            writer_id = query_id(batch)

            def attempt() -> None:
                rows = batch
                if join is not None:
                    rows = join(rows, moment_of(batch.sparkSession, checkpoint, batch_id, live or {}, clock))
                if prepare is not None:
                    rows = prepare(rows)
                table.write_batch(rows, batch_id, writer_id)

            with_retries(attempt, retries, before_retry)
            if maintenance is not None:
                maintenance.after(table, batch_id)

        base = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return _trigger(base.foreachBatch(write), trigger_seconds)

    return Sink(name or table.spec.name, writer)


def fan_out_sink(
    name: str,
    outputs: Mapping[str, tuple[Callable[[DataFrame], DataFrame], UpsertTable]],
    retries: int = 1,
    trigger_seconds: float | None = None,
) -> Sink:
    """Several keyed tables from one pass over the input.

    Each micro-batch is kept while the outputs are derived from it and written. The outputs then
    share one query, one checkpoint and one restart.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer_id = query_id(batch)
        batch.persist()
        try:
            for derive, table in outputs.values():
                rows = derive(batch)
                with_retries(
                    lambda rows=rows, table=table: table.write_batch(rows, batch_id, writer_id),
                    retries,
                )
        finally:
            batch.unpersist()

    def writer(df: DataFrame, checkpoint: str) -> DataStreamWriter:
        base = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return _trigger(base.foreachBatch(write), trigger_seconds)

    return Sink(name, writer)


def _times_as_text(df: DataFrame) -> DataFrame:
    """Times with all their microseconds as text, as far as they are columns of their own."""
    times = [f.name for f in df.schema if isinstance(f.dataType, (TimestampType, TimestampNTZType))]
    return df.withColumns({c: df[c].cast("string") for c in times})


def csv_sink(
    name: str,
    output_dir: str,
    trigger_seconds: float | None = 10,
    timestamp_format: str | None = None,
) -> Sink:
    """Appends CSV files with a header below ``<output_dir>/<name>.csv``.

    Times keep their microseconds unless a ``timestamp_format`` says otherwise.
    """

    def writer(df: DataFrame, checkpoint: str) -> DataStreamWriter:
        rows = _times_as_text(df) if timestamp_format is None else df
        base = (
            rows.writeStream.outputMode("append")
            .option("timestampFormat", timestamp_format or _WHOLE_TIME_FORMAT)
            .format("csv")
            .option("header", "true")
            .option("path", f"{output_dir.rstrip('/')}/{name}.csv")
            .option("checkpointLocation", checkpoint)
        )
        return _trigger(base, trigger_seconds)

    return Sink(name, writer)


def memory_sink(name: str, output_mode: str = "append") -> Sink:
    """Keeps the rows in the driver as a table named like the sink: for tests only."""

    def writer(df: DataFrame, checkpoint: str) -> DataStreamWriter:
        base = df.writeStream.outputMode(output_mode).format("memory").queryName(name)
        return base.option("checkpointLocation", checkpoint)

    return Sink(name, writer)


def to_messages(
    df: DataFrame,
    key: str | None,
    timestamp_format: str | None = None,
    beside: tuple[str, ...] = (),
) -> DataFrame:
    """Rows as messages: the key as text, the row as JSON in which NULL fields are left out.

    Columns named in ``beside`` stay next to the message and are not part of it. Times keep their
    microseconds unless a ``timestamp_format`` says otherwise.
    """
    fields = [c for c in df.columns if c not in beside]
    chosen = F.lit(None) if key is None else F.col(key)
    times = [] if timestamp_format else [f.name for f in df.schema if isinstance(f.dataType, (TimestampType, TimestampNTZType))]
    shown = [df[c].cast("string").alias(c) if c in times else df[c] for c in fields]
    value = F.to_json(F.struct(*shown), {"timestampFormat": timestamp_format or _WHOLE_TIME_FORMAT})
    return df.select(chosen.cast("string").alias("key"), value.alias("value"), *beside)


def message_sink(
    name: str,
    key: str | None,
    target: str | Mapping[str, str],
    timestamp_format: str | None = None,
    trigger_seconds: float | None = None,
    values_only: bool = False,
) -> Sink:
    """Rows as messages: to a topic, given the options of the Kafka sink, or to files of lines.

    A line is a JSON object with the message's ``key`` and ``value``, both text, which
    ``sources.files.message_dir_stream`` reads; with ``values_only`` it is the value alone.
    """

    def writer(df: DataFrame, checkpoint: str) -> DataStreamWriter:
        messages = to_messages(df, key, timestamp_format)
        if not isinstance(target, str):
            lines = messages.writeStream.format("kafka").options(**target)
        elif values_only:
            lines = messages.select("value").writeStream.format("text").option("path", target)
        else:
            lines = messages.writeStream.format("json").option("path", target)
        return _trigger(
            lines.outputMode("append").option("checkpointLocation", checkpoint), trigger_seconds
        )

    return Sink(name, writer)


SINKS: dict[str, Callable[..., Sink]] = {
    "upsert": upsert_sink,
    "csv": csv_sink,
    "memory": memory_sink,
    "messages": message_sink,
}
OUTPUT_MODES = {
    "upsert": ["update"],
    "csv": ["append"],
    "memory": ["append", "update", "complete"],
    "messages": ["append"],
}


def create_sink(kind: str, output_mode: str, *args, **options) -> Sink:
    """A sink by its short name; an output mode it does not take is an error."""
    if kind not in SINKS:
        raise ValueError(f"no sink {kind}; there are {sorted(SINKS)}")
    if output_mode not in OUTPUT_MODES[kind]:
        raise ValueError(f"sink {kind} takes output mode {OUTPUT_MODES[kind]}, not {output_mode}")
    if kind in ("upsert", "memory"):
        options["output_mode"] = output_mode
    return SINKS[kind](*args, **options)
