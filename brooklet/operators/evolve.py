"""Messages with a schema id: from the writer's version to the version a reader asks for.

Bodies are JSON, or Avro binary where the spark-avro package is on the class path.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.avro_schema import READABLE_FROM, ReaderField, reader_fields, reader_struct
from ..functions.envelope import body_of, bytes_to_id, seal
from ..functions.parse import once
from .enrich import join_counted
from .registry import get_schema, list_schemas

REASON = "reason"
#: A registry of so many schemas is broadcast: a name, a flag per reader field and a reason each.
BROADCAST_SCHEMAS = 50_000
BAD_TEXT = "_corrupt_record"
WRITER_RECORD = "type string, fields array<struct<name: string, type: string>>"
PRIMITIVE = r'(?:^|[\s,\[:"])(null|boolean|int|long|float|double|bytes|string)(?:$|[\s,\]}"])'


def encode_envelope(df: DataFrame, body: str = "body", schema_id: str = "schema_id") -> DataFrame:
    """Replaces schema id and body by one binary ``value``."""
    kept = [c for c in df.columns if c not in (body, schema_id)]
    return df.select(*kept, seal(F.col(schema_id), F.col(body)).alias("value"))


def split_envelope(messages: DataFrame) -> DataFrame:
    """Replaces the binary ``value`` by ``schema_id`` and ``body``; both NULL in short values."""
    kept = [c for c in messages.columns if c != "value"]
    return messages.select(
        *kept, bytes_to_id(F.col("value")).alias("schema_id"), body_of(F.col("value")).alias("body")
    )


def writer_fields(avro_schema: Column) -> Column:
    """The fields of a record schema as a map from name to the primitives in the type.

    NULL if the text is no such schema, or has a field without a name or two of the same name.
    """
    fields = F.from_json(avro_schema, WRITER_RECORD)["fields"]
    names = F.transform(fields, lambda f: f["name"])
    sound = ~F.exists(names, lambda n: n.isNull()) & (F.size(F.array_distinct(names)) == F.size(names))
    typed = F.transform(fields, lambda f: F.struct(f["name"], F.regexp_extract_all(f["type"], F.lit(PRIMITIVE), F.lit(1))))
    return F.map_from_entries(F.when(sound, typed))


def resolve(
    written: Column, fields: list[ReaderField], fill_nullable: bool = False
) -> tuple[Column, Column]:
    """Compares a writer's fields with a reader's.

    Gives the reason why the reader cannot read any such record, or NULL, and for each of its
    fields whether the writer has it. A field the writer lacks needs a default; ``fill_nullable``
    lets nullable fields do without. Types may widen.
    """
    problems, has = [F.when(written.isNull(), F.lit("writer schema is not a record"))], []
    for f in fields:
        present = F.map_contains_key(written, f.name)
        has.append(present)
        if not f.has_default and not (fill_nullable and f.nullable):
            problems.append(F.when(~present, F.lit(f"field {f.name} has no default")))
        types = F.element_at(written, F.lit(f.name))
        accepted = F.arrays_overlap(types, F.array(*map(F.lit, READABLE_FROM[f.primitive])))
        problems.append(F.when(present & ~accepted, F.lit(f"type of field {f.name} is not readable")))
    return F.coalesce(*problems), F.array(*has)


def evolve(body: Column, has: Column, fields: list[ReaderField]) -> tuple[Column, Column]:
    """The record as its reader sees it, and the reason why there is none, or NULL.

    Fields the reader lacks are gone, and those the writer lacks take their defaults.
    """
    values, problems = [], [F.when(body.isNull() | body[BAD_TEXT].isNotNull(), F.lit("unreadable body"))]
    for i, f in enumerate(fields):
        default = F.lit(f.default if f.has_default else None).cast(f.spark_type)
        values.append(F.when(F.get(has, i), body[f.name]).otherwise(default).alias(f.name))
        if not f.nullable:
            missing = F.get(has, i) & body[f.name].isNull()
            problems.append(F.when(missing, F.lit(f"field {f.name} has no value")))
    return F.struct(*values), F.coalesce(*problems)


def by_name(name: Column, choices: Mapping[str, Column]) -> Column:
    """The choice for the name; NULL for other names."""
    first, *rest = choices.items()
    return reduce(
        lambda chain, c: chain.when(name == c[0], c[1]), rest, F.when(name == first[0], first[1])
    )


def decode_all(
    messages: DataFrame,
    registry: DataFrame,
    reader_versions: Mapping[str, int],
    fill_nullable: bool = False,
) -> DataFrame:
    """All messages, each read once, with their records in a column per schema name.

    Behind the message's other columns: schema_id, body, ``name`` (of the schema whose reader the record
    is for, NULL if there is no record), ``record_<i>`` for the i-th configured name, and the reason
    why there is none. Only the reader schemas, one per configured name, and whether the
    registry is small are fetched when the query is built. Schemas are compared once per registry
    row, and any number of writer versions costs one join, which moves no message if the registry
    has at most ``BROADCAST_SCHEMAS`` rows.
    """
    readers = _readers(registry, reader_versions)
    writers = registry.select(F.col("id").alias("schema_id"), *_writer_columns(readers, F.col("name"), fill_nullable))
    rows = join_counted(split_envelope(messages), writers, "schema_id", "left_outer", BROADCAST_SCHEMAS)
    return _judged(rows, [c for c in messages.columns if c != "value"], readers)


def decode_attached(
    rows: DataFrame, registry: DataFrame, reader_versions: Mapping[str, int], fill_nullable: bool = False
) -> DataFrame:
    """``decode_all`` for messages that bring their writer's schema along, as those that have waited for it do.

    ``rows`` have schema_id, body, writer_name and avro_schema, NULL where the schema never came; only the
    readers are taken from the registry.
    """
    readers = _readers(registry, reader_versions)
    kept = [c for c in rows.columns if c not in ("schema_id", "body", "writer_name", "avro_schema", "version")]
    schema = _writer_columns(readers, F.col("writer_name"), fill_nullable)
    return _judged(rows.select(*kept, "schema_id", "body", *schema), kept, readers)


def _readers(registry: DataFrame, versions: Mapping[str, int]) -> dict[str, list[ReaderField]]:
    return {
        name: reader_fields(get_schema(registry, name=name, version=version)["avro_schema"])
        for name, version in versions.items()
    }


def _writer_columns(
    readers: Mapping[str, list[ReaderField]], name: Column, fill_nullable: bool
) -> list[Column]:
    """Of a writer's schema: its name, why no record of it can be read, and which of the reader's fields it has."""
    written = writer_fields(F.col("avro_schema"))
    resolved = {n: resolve(written, fields, fill_nullable) for n, fields in readers.items()}
    problem = F.when(name.isin(*readers), by_name(name, {n: r[0] for n, r in resolved.items()})).otherwise(F.lit("no reader version"))
    return [name.alias("writer_name"), problem.alias("schema_problem"), by_name(name, {n: r[1] for n, r in resolved.items()}).alias("has")]


def _judged(rows: DataFrame, kept: list[str], readers: Mapping[str, list[ReaderField]]) -> DataFrame:
    """Records and reasons of messages whose writer is known or NULL."""
    # Each body is parsed once, as the reader of its own schema name sees it.
    writer = F.col("writer_name")
    text = F.col("body").cast("string")
    bodies = {name: f"_body{i}" for i, name in enumerate(readers)}
    rows = rows.select(
        "*",
        once(
            F.struct(
                *[
                    F.when(writer == name, F.from_json(text, _with_bad_text(fields))).alias(bodies[name])
                    for name, fields in readers.items()
                ]
            )
        ),
    )
    decoded = {n: evolve(F.col(bodies[n]), F.col("has"), fields) for n, fields in readers.items()}
    reason = (
        F.when(F.col("schema_id").isNull(), F.lit("no schema id"))
        .when(writer.isNull(), F.lit("unknown schema id"))
        .when(F.col("schema_problem").isNotNull(), F.col("schema_problem"))
        .otherwise(by_name(writer, {n: d[1] for n, d in decoded.items()}))
    )
    judged = rows.withColumn(REASON, reason)
    named = F.when(F.col(REASON).isNull(), writer)
    records = [F.when(named == n, decoded[n][0]).alias(f"record_{i}") for i, n in enumerate(readers)]
    return judged.select(*kept, "schema_id", "body", named.alias("name"), *records, REASON)


def decode(
    messages: DataFrame,
    registry: DataFrame,
    reader_versions: Mapping[str, int],
    strict: bool = False,
    fill_nullable: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Messages as the records their readers ask for, by schema name, and those without one.

    Each frame has the other message columns next to the record; the rejects have the schema id,
    the body and the reason. In strict mode a message without a record fails the query instead.
    Every frame that is used reads the messages; ``decode_all`` reads them once for all names.
    """
    kept = [c for c in messages.columns if c != "value"]
    judged = decode_all(messages, registry, reader_versions, fill_nullable)
    name = F.col("name")
    if strict:
        # In the filter itself, so that no other filter on the name runs before it.
        problem = F.concat(F.lit("message without a record: "), F.col(REASON))
        name = F.when(F.col(REASON).isNull(), name).otherwise(F.raise_error(problem))
    records = {
        n: judged.where(name == n).select(*kept, f"record_{i}.*") for i, n in enumerate(reader_versions)
    }
    return records, judged.where(F.col(REASON).isNotNull()).select(*kept, "schema_id", "body", REASON)


def _with_bad_text(fields: list[ReaderField]):
    return reader_struct(fields).add(BAD_TEXT, "string")


def decode_avro(
    messages: DataFrame, registry: DataFrame, name: str, reader_version: int
) -> tuple[DataFrame, DataFrame]:
    """Avro binary bodies of one schema name, read as the given version, and all other messages.

    Needs spark-avro, whose decoder takes the writer schema as a literal. So there is one branch
    per writer version of the name, and the schemas of the name are fetched to build the query.
    """
    from pyspark.sql.avro import functions as avro

    reader = get_schema(registry, name=name, version=reader_version)["avro_schema"]
    writers = list_schemas(registry, name=name).select("id", "avro_schema").collect()
    kept = [c for c in messages.columns if c != "value"]
    parts = split_envelope(messages)

    def read(writer: Row) -> DataFrame:
        record = avro.from_avro(F.col("body"), writer["avro_schema"], {"avroSchema": reader})
        own = parts.where(F.col("schema_id") == writer["id"])
        return own.select(*kept, record.alias("record")).select(*kept, "record.*")

    known = F.coalesce(F.col("schema_id").isin(*[w["id"] for w in writers]), F.lit(False))
    return reduce(DataFrame.unionByName, map(read, writers)), parts.where(~known)
