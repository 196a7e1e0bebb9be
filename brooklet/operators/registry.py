"""A versioned schema registry held as a table of records ``id, name, version, avro_schema``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.avro_schema import parsing_form
from ..functions.parse import once
from ..schemas import INT, REGISTRY, TEXT, struct
from ..streaming.files import children, claim
from ..streaming.upsert import no_rows, read_if_present
from .enrich import join_static
from .latest import latest

# How a schema file is named, and the fields of a schema message.
FILE_PATTERN = r"^([a-zA-Z0-9_.]+)_v(\d+)_(\d+)\.avsc$"
SCHEMA_MESSAGE = struct(id=INT, name=TEXT, version=INT, avroSchema=TEXT)

COLUMNS = REGISTRY.fieldNames()


class SchemaNotFound(LookupError):
    """No schema answers the question."""


def registry_from_dir(spark: SparkSession, path: str) -> DataFrame:
    """Schemas of a directory; name, version and id come from the file names.

    Files with other names are skipped.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("avro_schema")
    )
    return (
        files.where(F.col("file").rlike(FILE_PATTERN))
        .select(
            F.regexp_extract("file", FILE_PATTERN, 3).cast("int").alias("id"),
            F.regexp_extract("file", FILE_PATTERN, 1).alias("name"),
            F.regexp_extract("file", FILE_PATTERN, 2).cast("int").alias("version"),
            "avro_schema",
        )
        .withColumn("parsing_form", parsing_form("avro_schema"))
    )


def registry_history(messages: DataFrame) -> DataFrame:
    """Schema messages as registry records without their form, with the offset that orders them."""
    record = F.from_json(F.col("value").cast("string"), SCHEMA_MESSAGE)
    rows = messages.select("offset", once(record)).where(F.col("id").isNotNull())
    return rows.withColumnRenamed("avroSchema", "avro_schema")


def _with_form(rows: DataFrame) -> DataFrame:
    return rows.withColumn("parsing_form", parsing_form("avro_schema")).select(*COLUMNS)


def registry_rejects(messages: DataFrame) -> DataFrame:
    """Schema messages that are no registry records: offset, raw value and the reason."""
    text = F.col("value").cast("string")
    parsed = F.from_json(text, SCHEMA_MESSAGE)
    reason = F.when(text.isNull(), "no value").when(F.get_json_object(text, "$").isNull(), "not JSON").otherwise("no id")
    return messages.where(parsed["id"].isNull()).select("offset", "value", reason.alias("reason"))


def schemas_by_id(history: DataFrame) -> DataFrame:
    """The last record of each id."""
    return _with_form(latest(history, ["id"], ["offset"]))


def schemas_by_version(history: DataFrame) -> DataFrame:
    """The last record of each name and version."""
    return _with_form(latest(history, ["name", "version"], ["offset"]))


def schemas_by_form(history: DataFrame) -> DataFrame:
    """The last record of each form; records whose schema is no flat record have none.

    Equal texts are folded before the form is made, which is once for each of them.
    """
    texts = latest(history, ["avro_schema"], ["offset"])
    formed = texts.withColumn("parsing_form", parsing_form("avro_schema"))
    return latest(formed, ["parsing_form"], ["offset"], F.col("parsing_form").isNotNull()).select(*COLUMNS)


def list_schemas(
    registry: DataFrame,
    name: str | None = None,
    version: int | None = None,
    schema_id: int | None = None,
) -> DataFrame:
    """Registry records, narrowed by any of name, version and id."""
    wanted = {"name": name, "version": version, "id": schema_id}
    for column, value in wanted.items():
        if value is not None:
            registry = registry.where(F.col(column) == F.lit(value))
    return registry


def get_schema(
    registry: DataFrame,
    schema_id: int | None = None,
    name: str | None = None,
    version: int | None = None,
) -> Row:
    """One schema, by id or by name and version."""
    if schema_id is None and (name is None or version is None):
        raise ValueError("give an id, or a name and a version")
    by_id = schema_id is not None
    found = list_schemas(
        registry, None if by_id else name, None if by_id else version, schema_id
    ).take(1)
    if not found:
        wanted = f"id={schema_id}" if by_id else f"name={name}, version={version}"
        raise SchemaNotFound(f"no schema with {wanted}")
    return found[0]


def form_of(spark: SparkSession, avro_schema: str) -> str | None:
    """The form of one schema text, None if it is no flat record schema."""
    return spark.range(1).select(parsing_form(F.lit(avro_schema)).alias("form")).first()["form"]


def find_schema(registry: DataFrame, avro_schema: str) -> Row:
    """The record of a flat record schema that is equal up to attributes, their order and white space."""
    form = form_of(registry.sparkSession, avro_schema)
    found = [] if form is None else registry.where(F.col("parsing_form") == F.lit(form)).take(1)
    if not found:
        raise SchemaNotFound(f"no schema with the form {form}")
    return found[0]


def match_schemas(schemas: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry id, name and version for each row of a table with a ``parsing_form``."""
    side = registry.select("parsing_form", "id", "name", "version")
    return join_static(schemas, side, "parsing_form", "left_outer")


def next_id(registry: DataFrame, column: str = "id") -> DataFrame:
    """The smallest free non-negative id, as one row ``next_id``.

    That is 0, or the successor of a used id, so no range of numbers has to be listed: each id
    names itself as used and its successor as a candidate, in one aggregation.
    """
    key = F.col(column).cast("bigint")
    named = registry.where(key >= 0).select(
        F.inline(
            F.array(
                F.struct(key.alias("number"), F.lit(True).alias("used")),
                F.struct((key + 1).alias("number"), F.lit(False).alias("used")),
            )
        )
    )
    zero = registry.sparkSession.range(1).select(F.col("id").alias("number"), F.lit(False).alias("used"))
    numbers = named.union(zero).groupBy("number").agg(F.max("used").alias("used"))
    return numbers.where(~F.col("used")).agg(F.min("number").cast("int").alias("next_id"))


def register_schema(
    spark: SparkSession, path: str, name: str, version: int, avro_schema: str
) -> Row:
    """Adds a schema to the registry table at ``path`` and returns its record.

    The text must be JSON. Any number of writers may register at once: an id belongs to the one who
    creates its claim, a file below ``path`` that can be created only once. The ids that are claimed
    count as used, so an id is not given twice even if a writer breaks off before its record is there.
    """
    try:
        json.loads(avro_schema)
    except ValueError as problem:
        raise ValueError(f"not a schema: {problem}") from problem
    form = form_of(spark, avro_schema)
    claims = f"{path.rstrip('/')}/_claims"
    free = next_id(read_registry(spark, path)).first()["next_id"]
    while not claim(spark, f"{claims}/{free:010d}", name):
        free = next_id(_used_ids(spark, path, claims)).first()["next_id"]
    record = (free, name, version, avro_schema, form)
    spark.createDataFrame([record], REGISTRY).write.mode("append").parquet(f"{path.rstrip('/')}/records/claimed={free}")
    return Row(*COLUMNS)(*record)


def _used_ids(spark: SparkSession, path: str, claims: str) -> DataFrame:
    """Ids of the records and of the claims."""
    claimed = [(int(name),) for name in children(spark, claims) or [] if name.isdigit()]
    return read_registry(spark, path).select("id").union(spark.createDataFrame(claimed, "id int"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry table; empty where nothing has been registered."""
    found = read_if_present(spark, f"{path.rstrip('/')}/records", REGISTRY)
    return no_rows(spark, REGISTRY) if found is None else found.select(*REGISTRY.names)
