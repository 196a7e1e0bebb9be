"""Joins with keyed static tables, which Spark broadcasts or shuffles by what it knows of their size."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_static(df: DataFrame, side: DataFrame, key: str, how: str) -> DataFrame:
    """Joins rows to a static table that holds each key once.

    Spark picks the way from the bytes it knows of the table, for a stream anew in each batch: a
    broadcast below ``spark.sql.autoBroadcastJoinThreshold``, else a shuffle in which it splits
    the partitions of hot keys, and of rows without a key, as it finds them.
    """
    return df.join(side, key, how)


def join_counted(df: DataFrame, side: DataFrame, key: str, how: str, most: int) -> DataFrame:
    """Joins rows to a static table that is usually small, but of which Spark may know no size.

    One job looks whether it has at most ``most`` rows; then it is broadcast, and the rows of the
    other side, of which a few keys may hold nearly all, stay where they are.
    """
    few = side.limit(most + 1).count() <= most
    return join_static(df, F.broadcast(side) if few else side, key, how)


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Mapping[str, str | Column],
    how: str = "left_outer",
) -> DataFrame:
    """Adds columns of the row of ``dim`` with the same key; ``dim`` holds a key once.

    ``columns`` maps new names to columns of ``dim``.
    """
    side = dim.select(
        F.col(key),
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()],
    )
    return join_static(df, side, key, how).select(*df.columns, *columns)


def mark_known(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    name: str,
) -> DataFrame:
    """Adds a flag: does ``dim`` hold the key of the row? False for rows without a key."""
    marked = enrich(df, dim, key, {name: F.lit(True)})
    return marked.withColumn(name, F.coalesce(name, F.lit(False)))


def orphans(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    constants: Mapping[str, Column],
    dedup: str = "batch",
) -> DataFrame:
    """Keys of ``df`` that ``dim`` does not hold, with constant columns for the rest of the row.

    On a static frame the keys are made distinct before the join, so only distinct keys are
    shuffled and no key is hot. On a stream ``dedup="batch"`` keeps no state: the same key may be
    emitted again and a keyed sink folds the copies; ``dedup="global"`` remembers all keys.
    """
    if dedup not in ("batch", "global"):
        raise ValueError("dedup is 'batch' or 'global'")
    referred = df.where(F.col(key).isNotNull())
    keys = dim.select(key)
    if df.isStreaming:
        missing = join_static(referred.select(key), keys, key, "left_anti")
        if dedup == "global":
            missing = missing.dropDuplicates([key])
    else:
        missing = join_static(referred.select(key).distinct(), keys, key, "left_anti")
    return missing.select(key, *[value.alias(name) for name, value in constants.items()])
