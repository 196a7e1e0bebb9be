"""All events of a transaction in time order, and corrected records fed through again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE, OFFSET, IN_SLICE = "_slice", "_offset", "_in_slice"


def lifecycle(
    df: DataFrame, key: str, ts: str, tie_break: Sequence[str] = (), time_slice: str = "hour"
) -> DataFrame:
    """Numbers the events of each key from 1 in time order, as ``step``. Static frames only.

    Events are ranked within a slice of time, and the counts of the earlier slices of the key are
    added. No task ever holds more than one slice of one key, so a key with a large part of all
    events does not end up in a single task. Rows without key or time stay, with no step.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    sliced = rows.withColumn(SLICE, F.date_trunc(time_slice, ts))
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(key, SLICE)
        .agg(F.count(F.lit(1)).alias(IN_SLICE))
        .select(key, SLICE, F.coalesce(F.sum(IN_SLICE).over(earlier), F.lit(0)).alias(OFFSET))
    )
    within = Window.partitionBy(key, SLICE).orderBy(ts, *tie_break)
    ranked = sliced.withColumn(IN_SLICE, F.row_number().over(within))
    steps = ranked.join(offsets, [key, SLICE])
    numbered = steps.select(*df.columns, (F.col(OFFSET) + F.col(IN_SLICE)).alias("step"))
    rest = df.where(F.col(key).isNull() | F.col(ts).isNull())
    return numbered.unionByName(rest.withColumn("step", F.lit(None).cast("long")))


def reprocess(corrected: DataFrame, source: DataFrame) -> DataFrame:
    """The source with corrected records added, to be run through the same flow again."""
    return source.unionByName(corrected.select(*source.columns))
