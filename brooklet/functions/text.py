"""Fields of delimited payloads and keyword search."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def nth_field(column: Column | str, n: int, separator: str = ",") -> Column:
    """The n-th field (counted from 1) of a delimited text; NULL where the text is too short."""
    text = F.col(column) if isinstance(column, str) else column
    return F.get(F.split(text, re.escape(separator)), n - 1)


def has_keyword(column: Column | str, keywords: Sequence[str]) -> Column:
    """True where the whole text holds one of the keywords, upper or lower case."""
    if not keywords:
        raise ValueError("at least one keyword is needed")
    lowered = F.lower(F.col(column) if isinstance(column, str) else column)
    found = F.contains(lowered, F.lit(keywords[0].lower()))
    for keyword in keywords[1:]:
        found = found | F.contains(lowered, F.lit(keyword.lower()))
    return found
