"""Counts per event-time window, and bounded de-duplication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import earliest


def with_watermark(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    """The watermark matters to streams only; static frames stay as they are."""
    return df.withWatermark(ts, delay) if delay is not None and df.isStreaming else df


def _by_window(
    df: DataFrame, ts: str, width: str, delay: str | None, measures: Mapping[str, Column]
) -> DataFrame:
    grouped = with_watermark(df, ts, delay).groupBy(F.window(ts, width).alias("window"))
    counted = grouped.agg(*[m.alias(name) for name, m in measures.items()])
    return counted.select(
        F.col("window.start").alias("start_ts"), F.col("window.end").alias("end_ts"), *measures
    )


def count_by_window(
    df: DataFrame, ts: str, width: str = "1 minute", delay: str | None = "10 seconds"
) -> DataFrame:
    """Rows per tumbling window; rows without an event time count nowhere."""
    return _by_window(df, ts, width, delay, {"num_transactions": F.count(F.lit(1))})


def window_metrics(
    df: DataFrame,
    ts: str,
    width: str = "1 minute",
    delay: str | None = "10 seconds",
    flags: Mapping[str, Column] | None = None,
    price: str = "price",
) -> DataFrame:
    """Rows, average price and rows per flag in each tumbling window, in one aggregation.

    Prices are texts: those that are not numbers of up to 38 digits are left out. Wholes and
    fractions (17 digits) are added apart, as decimals, so that nothing is cut and the average does
    not depend on the order of the rows.
    """
    fine = F.col(price).try_cast("decimal(37,17)")
    whole = F.coalesce(F.floor(fine).cast("decimal(38,0)"), F.col(price).try_cast("decimal(38,0)"))
    wholes = F.sum(whole)
    fractions = F.coalesce(F.sum((fine - F.floor(fine)).cast("decimal(18,17)")), F.lit(0)).cast("decimal(37,17)")
    small = wholes.try_cast("decimal(18,0)")
    total = F.coalesce((small + fractions).cast("double"), wholes.cast("double") + fractions.cast("double"))
    measures = {
        "num_transactions": F.count(F.lit(1)),
        "avg_price": total / F.nullif(F.count(whole), F.lit(0)),
    }
    measures |= {name: F.count_if(flag) for name, flag in (flags or {}).items()}
    return _by_window(df, ts, width, delay, measures)


def dedup_by_id(
    df: DataFrame, ids: list[str], ts: str, delay: str | None = None, salts: int = 1
) -> DataFrame:
    """The first row per id: by time on a static frame, by arrival on a stream, which forgets an id
    once the watermark has passed it by ``delay``.

    With ``salts`` above 1 a stream drops copies in two steps, first among the rows that the same
    read tasks brought: for logs in which copies of one id make up much of the volume.
    """
    if not df.isStreaming:
        return earliest(df, ids, [ts])
    if delay is None:
        raise ValueError("a stream needs a delay to bound its state")
    rows = df.withWatermark(ts, delay)
    if salts > 1:
        salted = rows.withColumn("_salt", F.spark_partition_id() % salts)
        rows = salted.dropDuplicatesWithinWatermark([*ids, "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(ids)
