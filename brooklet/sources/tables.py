"""Keyed tables as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..streaming.upsert import UpsertTable
from .messages import Source


def table_source(table: UpsertTable, view: str | None = None) -> Source:
    """The current rows of a keyed table, read at each call and registered as a view.

    The table has its own schema; the one that is asked for is not used.
    """

    def load(schema: StructType) -> DataFrame:
        return table.register_view(view)

    return load
