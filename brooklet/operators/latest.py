"""The last version of each key, or the first."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_row"


def latest(
    df: DataFrame, key: Sequence[str], order: Sequence[str], where: Column | None = None
) -> DataFrame:
    """The row with the greatest ``order`` per key; ties fall to the greatest remaining columns.

    An aggregate rather than a ranking: each task first folds its own rows, so a key that holds a
    large part of the table travels as one row per task. NULL sorts below every value. Static
    frames only.
    """
    return _picked(df if where is None else df.where(where), key, order, F.max)


def earliest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, as ``latest`` is that with the greatest."""
    return _picked(df, key, order, F.min)


def _picked(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], pick: Callable[[Column], Column]
) -> DataFrame:
    first = [c for c in order if c not in key]
    rest = [c for c in rows.columns if c not in key and c not in first]
    if not first and not rest:
        return rows.distinct()
    # The order comes first in the struct, so the struct that is picked is the version that is wanted.
    found = rows.groupBy(*key).agg(pick(F.struct(*first, *rest)).alias(ROW))
    return found.select(*key, f"{ROW}.*").select(*rows.columns)
