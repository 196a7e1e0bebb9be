"""Record checks as Column expressions.

All of them keep SQL's three-valued logic: a NULL input to a domain check gives NULL, not false.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(columns: Sequence[str]) -> Column:
    """True where none of the columns is NULL; never NULL itself."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns), F.lit(True))


def in_domain(column: str, domain: Iterable[str]) -> Column:
    """Membership, NULL for NULL."""
    return F.col(column).isin(*domain)


def all_of(checks: Sequence[Column]) -> Column:
    """Conjunction: false wins over NULL, NULL wins over true."""
    return reduce(and_, checks, F.lit(True))
