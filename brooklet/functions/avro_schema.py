"""Avro schema texts of flat records: the fields of a reader, and the form by which schemas are compared."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Avro primitives, their Spark types, and the writer types each reader type accepts.
SPARK_TYPES: dict[str, DataType] = {
    "boolean": BooleanType(),
    "int": IntegerType(),
    "long": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "bytes": BinaryType(),
    "string": StringType(),
}
READABLE_FROM = {
    "boolean": ["boolean"],
    "int": ["int"],
    "long": ["int", "long"],
    "float": ["int", "long", "float"],
    "double": ["int", "long", "float", "double"],
    "bytes": ["bytes", "string"],
    "string": ["string", "bytes"],
}
PRIMITIVES = {"null", *SPARK_TYPES}

NO_DEFAULT = object()


@dataclass(frozen=True)
class ReaderField:
    """One field of a reader schema."""

    name: str
    primitive: str
    nullable: bool
    default: Any = NO_DEFAULT

    @property
    def has_default(self) -> bool:
        return self.default is not NO_DEFAULT

    @property
    def spark_type(self) -> DataType:
        return SPARK_TYPES[self.primitive]


def reader_fields(avro_schema: str) -> list[ReaderField]:
    """Fields of a flat record schema: primitives, or unions of one primitive with null."""
    record = json.loads(avro_schema)
    if not isinstance(record, dict) or record.get("type") != "record":
        raise ValueError("a record schema is needed")
    fields = []
    for field in record["fields"]:
        declared = field["type"]
        branches = declared if isinstance(declared, list) else [declared]
        names = [b["type"] if isinstance(b, dict) else b for b in branches]
        values = [n for n in names if n != "null"]
        if len(values) != 1 or values[0] not in SPARK_TYPES:
            raise ValueError(f"field {field['name']}: type {declared} is not supported")
        fields.append(
            ReaderField(
                field["name"], values[0], "null" in names, field.get("default", NO_DEFAULT)
            )
        )
    return fields


def reader_struct(fields: list[ReaderField]) -> StructType:
    return StructType([StructField(f.name, f.spark_type, True) for f in fields])


def parsing_form(schema: Column | str) -> Column:
    """Parsing canonical form of a flat record schema: its full name, and names and types of its fields.

    Attributes, their order and white space make no difference to it. A field is flat if its type
    is a primitive, with or without attributes, or a union of such. NULL for all other texts.
    """
    text = F.col(schema) if isinstance(schema, str) else schema
    record = F.from_json(text, "type string, name string, namespace string, fields array<struct<name: string, type: string>>")
    name, space = record["name"], record["namespace"]
    full = F.when(name.contains(".") | F.coalesce(space, F.lit("")).eqNullSafe(""), name).otherwise(F.concat(space, F.lit("."), name))

    def primitive(kind: Column) -> Column:
        named = F.when(kind.startswith("{"), F.get_json_object(kind, "$.type")).otherwise(kind)
        return F.when(named.isin(*sorted(PRIMITIVES)), F.concat(F.lit('"'), named, F.lit('"')))

    def typed(kind: Column) -> Column:
        branches = F.transform(F.from_json(kind, "array<string>"), primitive)
        union = F.when(~F.exists(branches, lambda b: b.isNull()), F.concat(F.lit("["), F.array_join(branches, ","), F.lit("]")))
        return F.when(kind.startswith("["), union).otherwise(primitive(kind))

    # A part that is NULL makes its field NULL, and a field that is NULL the whole form.
    fields = F.transform(record["fields"], lambda f: F.concat(F.lit('{"name":"'), f["name"], F.lit('","type":'), typed(f["type"]), F.lit("}")))
    form = F.concat(F.lit('{"name":"'), full, F.lit('","type":"record","fields":['), F.array_join(fields, ","), F.lit("]}"))
    return F.when((record["type"] == "record") & ~F.exists(fields, lambda f: f.isNull()), form)
