"""Directories of text files as streams and static tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.parse import once
from ..schemas import EVENT_TIME, TEXT, struct
from .messages import Source


def json_dir_stream(
    spark: SparkSession, path: str, event_time: str | None = None, files_per_trigger: int | None = None
) -> Source:
    """JSON files as a stream; ``files_per_trigger`` bounds a micro-batch."""

    def load(schema: StructType) -> DataFrame:
        reader = spark.readStream.schema(schema)
        if files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        frame = reader.json(path)
        return frame if event_time is None else frame.withColumn(EVENT_TIME, F.col(event_time))

    return load


def message_dir_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Files of messages, one JSON object with ``key`` and ``value`` per line, as a stream of both."""
    reader = spark.readStream.schema(struct(key=TEXT, value=TEXT))
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def json_file(spark: SparkSession, path: str, view: str | None = None) -> Source:
    """JSON lines as a static table. A trailing comma is tolerated, blank lines are left out."""

    def load(schema: StructType) -> DataFrame:
        lines = spark.read.text(path).where(F.trim("value") != "")
        frame = lines.select(once(F.from_json("value", schema)))
        if view is not None:
            frame.createOrReplaceTempView(view)
        return frame

    return load


def parquet_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet table as a stream, be it one file or a directory of files."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # As a pattern, the path may name a file; a plain path must be a directory.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
