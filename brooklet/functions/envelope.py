"""Message envelope: a big-endian 4-byte schema id, then the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_to_bytes(schema_id: Column) -> Column:
    """Four big-endian bytes of an int."""
    return F.unhex(F.right(F.lpad(F.hex(schema_id.cast("bigint")), 16, "0"), F.lit(8)))


def bytes_to_id(value: Column) -> Column:
    """Signed int held by the first four bytes; NULL where there are fewer."""
    unsigned = F.conv(F.hex(F.substring(value, 1, 4)), 16, 10).cast("bigint")
    signed = F.pmod(unsigned + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)
    return F.when(F.octet_length(value) >= 4, signed.cast("int"))


def body_of(value: Column) -> Column:
    """Everything after the id; NULL where there is no whole id."""
    size = F.octet_length(value)
    return F.when(size >= 4, F.substring(value, F.lit(5), size))


def seal(schema_id: Column, body: Column) -> Column:
    """Id and body in one binary value."""
    return F.concat(id_to_bytes(schema_id), body.cast("binary"))
