"""Parsed structs as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(parsed: Column) -> Column:
    """Expands a struct that is costly to compute into its fields, one row for one row.

    As the output of a generator the fields are values. Selected from the struct, each use of a
    field in a later filter or projection would be optimized into parsing the text again.
    """
    return F.inline(F.array(parsed))
