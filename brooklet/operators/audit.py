"""Row counts of several tables side by side."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.upsert import UpsertTable


def audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, num_rows`` per table, as a set union of one-row counts."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts).distinct()


def audit_tables(spark: SparkSession, tables: Mapping[str, UpsertTable]) -> DataFrame:
    """``table_name, num_rows`` of keyed tables, from their commits where these tell.

    The commit of a folded table has the rows of every folder, counted when it was written, so nothing
    is read; only a table with rows in its log, or with several layers, is counted.
    """
    told = {name: table.num_rows() for name, table in tables.items()}
    known = [(name, n) for name, n in told.items() if n is not None]
    rows = spark.createDataFrame(known, "table_name string, num_rows bigint")
    counted = {name: tables[name].read() for name, n in told.items() if n is None}
    return rows.union(audit_counts(counted)) if counted else rows
