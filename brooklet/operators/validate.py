"""Validation and routing of records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.checks import all_of, all_present, in_domain

VALID, INVALID, UNDECIDED = "valid", "invalid", "undecided"


def validate(
    df: DataFrame,
    mandatory: Sequence[str],
    domains: Mapping[str, Iterable[str]],
    timestamp: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Adds one flag per check, and ``valid_record`` as their three-valued conjunction.

    A text timestamp is parsed with the format; a typed one only has to be there.
    """
    flags = {"mandatory_fields_exist": all_present(mandatory)}
    flags |= {f"valid_{column}": in_domain(column, domain) for column, domain in domains.items()}
    if timestamp is not None:
        parsed = F.col(timestamp)
        if isinstance(df.schema[timestamp].dataType, StringType):
            pattern = None if timestamp_format is None else F.lit(timestamp_format)
            parsed = F.try_to_timestamp(parsed, pattern)
        flags["parsed_event_timestamp"] = parsed
        flags["correct_timestamp_format"] = parsed.isNotNull()
    checks = [c for name, c in flags.items() if name != "parsed_event_timestamp"]
    return df.withColumns(flags | {"valid_record": all_of(checks)})


def split(df: DataFrame, flag: str = "valid_record") -> dict[str, DataFrame]:
    """One frame per outcome; NULL is neither valid nor invalid and has its own frame."""
    return {
        VALID: df.where(F.col(flag)),
        INVALID: df.where(~F.col(flag)),
        UNDECIDED: df.where(F.col(flag).isNull()),
    }


def with_route(df: DataFrame, flag: str = "valid_record", name: str = "route") -> DataFrame:
    """The outcome as a column, to write or count all outcomes in one pass over the input."""
    route = (
        F.when(F.col(flag).isNull(), UNDECIDED).when(F.col(flag), VALID).otherwise(INVALID)
    )
    return df.withColumn(name, route)


def flag_record(
    df: DataFrame, domains: Mapping[str, Iterable[str]], name: str = "is_valid"
) -> DataFrame:
    """Domain membership of all columns as one flag."""
    return df.withColumn(name, all_of([in_domain(c, d) for c, d in domains.items()]))
