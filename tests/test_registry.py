"""Schema registry and schema evolution."""

import json
import struct as bits
from concurrent.futures import ThreadPoolExecutor

import pytest

from brooklet.functions.avro_schema import parsing_form, reader_fields
from brooklet.operators.evolve import decode, decode_all, encode_envelope, split_envelope
from brooklet.operators.registry import (
    SchemaNotFound,
    find_schema,
    form_of,
    get_schema,
    list_schemas,
    match_schemas,
    next_id,
    read_registry,
    register_schema,
    registry_from_dir,
    registry_history,
    schemas_by_form,
    schemas_by_id,
    schemas_by_version,
)
from brooklet.schemas import REGISTRY
from brooklet.streaming.files import claim


def record(*fields, name="Item"):
    return json.dumps({"type": "record", "name": name, "namespace": "n", "fields": list(fields)})


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


V1 = record(field("sku", "string"), field("shelf", "int"), field("weight", "double"))
V2 = record(field("sku", "string"), field("weight", ["null", "double"]), field("lot", "long"))
V3 = record(field("sku", "string"), field("weight", ["null", "double"]), field("lot", "long", default=7))
# Forms of flat records, written out.
FORM_V1 = '{"name":"n.Item","type":"record","fields":[{"name":"sku","type":"string"},{"name":"shelf","type":"int"},{"name":"weight","type":"double"}]}'
FORM_V2 = '{"name":"n.Item","type":"record","fields":[{"name":"sku","type":"string"},{"name":"weight","type":["null","double"]},{"name":"lot","type":"long"}]}'
SCHEMAS = [
    V1,
    V2,
    V3,
    record(name="Empty"),
    record(field("t", {"type": "long", "logicalType": "timestamp-millis"}), field("u", ["null", {"type": "string", "avro.java.string": "String"}], doc="d", order="ignore"), name="x.y.Full"),
    '{"fields": [{"type": "bytes", "name": "b"}], "name": "Bare", "doc": "z", "aliases": ["q"], "type": "record"}',
]


@pytest.mark.parametrize("schema", SCHEMAS)
def test_form_of_flat_records_equals_that_of_the_avro_library(spark, schema):
    avro = spark._jvm.org.apache.avro
    parser = getattr(avro.Schema, "Parser")()
    assert form_of(spark, schema) == avro.SchemaNormalization.toParsingForm(parser.parse(schema))


NESTED = record(field("a", {"type": "array", "items": "int"}))


def test_other_texts_have_no_form(spark):
    rows = [("{",), (None,), ("[1]",), ('{"a": 1}',), ('"int"',), (NESTED,), (record(field("a", "other.Name")),), (record(field("a", ["null", "n.Item"])),), (record({"name": "a"}),), (record({"type": "int"}),)]
    got = spark.createDataFrame(rows, "s string").select(parsing_form("s").alias("f"))
    assert {r["f"] for r in got.collect()} == {None}
    assert [form_of(spark, s) for s in (V1, V2, V3)] == [FORM_V1, FORM_V2, FORM_V2]


def messages(spark, records):
    rows = [(i, bytearray(json.dumps(r), "utf-8")) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "offset bigint, value binary")


def entry(schema_id, name, version, schema):
    return {"id": schema_id, "name": name, "version": version, "avroSchema": schema}


def test_last_record_wins_per_id_version_and_form(spark):
    history = registry_history(
        messages(
            spark,
            [entry(0, "item", 1, V1), entry(1, "item", 2, V2), entry(0, "item", 3, V1), entry(2, "item", 1, V3), {}],
        )
    )
    by_id = {r["id"]: r["version"] for r in schemas_by_id(history).collect()}
    assert by_id == {0: 3, 1: 2, 2: 1}
    by_version = {(r["name"], r["version"]): r["id"] for r in schemas_by_version(history).collect()}
    assert by_version == {("item", 1): 2, ("item", 2): 1, ("item", 3): 0}
    by_form = {r["parsing_form"]: (r["id"], r["version"]) for r in schemas_by_form(history).collect()}
    # Defaults are no part of the form, so the second and the third schema share theirs.
    assert by_form == {FORM_V1: (0, 3), FORM_V2: (2, 1)}


@pytest.mark.parametrize(
    ("ids", "expected"), [([0, 1, 3], 2), ([], 0), ([1, 2], 0), ([0, 1, 2], 3), ([-1, 0], 1), ([0, 0], 1)]
)
def test_next_id(spark, ids, expected):
    rows = spark.createDataFrame([(i,) for i in ids], "id int")
    assert [r["next_id"] for r in next_id(rows).collect()] == [expected]


def test_register_list_get_find(spark, tmp_path):
    path = f"{tmp_path}/registry"
    assert read_registry(spark, path).count() == 0
    assert register_schema(spark, path, "item", 1, V1)["id"] == 0
    assert register_schema(spark, path, "item", 2, V2)["id"] == 1
    assert register_schema(spark, path, "page", 1, record(name="Page"))["id"] == 2
    with pytest.raises(ValueError):
        register_schema(spark, path, "bad", 1, "{")
    registry = read_registry(spark, path)
    assert registry.count() == 3
    assert list_schemas(registry, name="item").count() == 2
    assert list_schemas(registry, name="item", version=2).first()["id"] == 1
    assert list_schemas(registry, schema_id=2).first()["name"] == "page"
    assert get_schema(registry, name="item", version=2)["id"] == 1
    assert get_schema(registry, schema_id=2)["name"] == "page"
    with pytest.raises(SchemaNotFound):
        get_schema(registry, schema_id=9)
    with pytest.raises(SchemaNotFound):
        get_schema(registry, name="item", version=9)
    with pytest.raises(ValueError):
        get_schema(registry, name="item")
    same = json.dumps(json.loads(V2) | {"doc": "other words"}, indent=4)
    assert find_schema(registry, same)["id"] == 1
    with pytest.raises(SchemaNotFound):
        find_schema(registry, record(field("z", "int")))
    asked = spark.createDataFrame([(V1,), ("x",)], "s string").select(parsing_form("s").alias("parsing_form"))
    assert sorted((r["id"] for r in match_schemas(asked, registry).collect()), key=str) == [0, None]


def test_directory(spark, tmp_path):
    (tmp_path / "item_v1_1.avsc").write_text(json.dumps(json.loads(V1), indent=2))
    (tmp_path / "my.name_v12_34.avsc").write_text(V2)
    (tmp_path / "registry.avsc").write_text(V3)
    (tmp_path / "item_v1_1.avsc.bak").write_text(V3)
    got = {r["id"]: r for r in registry_from_dir(spark, str(tmp_path)).collect()}
    assert {(r["name"], r["version"]) for r in got.values()} == {("item", 1), ("my.name", 12)}
    assert json.loads(got[1]["avro_schema"]) == json.loads(V1)
    assert got[1]["parsing_form"] == FORM_V1
    assert sorted(got) == [1, 34]


def test_envelope_bytes(spark):
    rows = spark.createDataFrame([(0, b"a"), (5, b""), (258, b"xyz"), (2**31 - 1, b"q")], "schema_id int, body binary")
    sealed = [bytes(r["value"]) for r in encode_envelope(rows).collect()]
    assert sealed == [bits.pack(">i", i) + b for i, b in [(0, b"a"), (5, b""), (258, b"xyz"), (2**31 - 1, b"q")]]
    back = split_envelope(encode_envelope(rows)).collect()
    assert [(r["schema_id"], bytes(r["body"])) for r in back] == [(0, b"a"), (5, b""), (258, b"xyz"), (2**31 - 1, b"q")]
    odd = spark.createDataFrame([(b"\x00\x01",), (None,), (bits.pack(">i", -2) + b"z",)], "value binary")
    assert [r["schema_id"] for r in split_envelope(odd).collect()] == [None, None, -2]
    assert [r["body"] and bytes(r["body"]) for r in split_envelope(odd).collect()] == [None, None, b"z"]


def registry_of(spark, schemas):
    rows = [(i, name, version, text, None) for i, name, version, text in schemas]
    return spark.createDataFrame(rows, REGISTRY)


ITEMS = [(3, "item", 1, V1), (9, "item", 2, V2), (4, "item", 3, V3)]
BODIES = [
    (0, 3, '{"sku":"a1","shelf":4,"weight":2.5}'),
    (1, 9, '{"sku":"b2","weight":null,"lot":12}'),
    (2, 9, '{"sku":"c3","lot":13}'),
    (3, 6, '{"sku":"d4"}'),
    (4, 9, '{"sku":"e'),
    (5, 9, '{"weight":1.0,"lot":14}'),
    (6, 9, '{"sku":"f6","lot":"x"}'),
]


def sealed(spark, bodies=BODIES):
    return encode_envelope(spark.createDataFrame(bodies, "offset int, schema_id int, body string"))


def outcome(spark, reader, **how):
    records, rejects = decode(sealed(spark), registry_of(spark, ITEMS), {"item": reader}, **how)
    good = {r["offset"]: tuple(r)[1:] for r in records["item"].collect()}
    return good, {r["offset"]: r["reason"] for r in rejects.collect()}


def test_new_required_field_without_default_is_rejected(spark):
    good, bad = outcome(spark, 2)
    assert good == {1: ("b2", None, 12), 2: ("c3", None, 13)}
    assert bad == {
        0: "field lot has no default",
        3: "unknown schema id",
        4: "unreadable body",
        5: "field sku has no value",
        6: "unreadable body",
    }


def test_default_fills_and_old_fields_go(spark):
    good, bad = outcome(spark, 3)
    assert good[0] == ("a1", 2.5, 7)
    assert sorted(bad) == [3, 4, 5, 6]


def test_nullable_field_needs_a_default_unless_asked_otherwise(spark):
    reader = record(field("sku", "string"), field("nick", ["null", "string"]))
    registry = registry_of(spark, [*ITEMS, (8, "item", 4, reader)])
    bodies = [BODIES[0]]
    records, rejects = decode(sealed(spark, bodies), registry, {"item": 4})
    assert records["item"].count() == 0
    assert rejects.first()["reason"] == "field nick has no default"
    records, rejects = decode(sealed(spark, bodies), registry, {"item": 4}, fill_nullable=True)
    assert [tuple(r) for r in records["item"].collect()] == [(0, "a1", None)]
    assert rejects.count() == 0


def test_types_widen_but_do_not_narrow(spark):
    wide = record(field("a", "long"), field("b", "double"))
    narrow = record(field("a", "int"), field("b", "int"))
    registry = registry_of(spark, [(1, "x", 1, narrow), (2, "x", 2, wide)])
    bodies = [(0, 1, '{"a":1,"b":2}'), (1, 2, '{"a":1,"b":2}')]
    records, rejects = decode(sealed(spark, bodies), registry, {"x": 2})
    assert sorted(tuple(r) for r in records["x"].collect()) == [(0, 1, 2.0), (1, 1, 2.0)]
    records, rejects = decode(sealed(spark, bodies), registry, {"x": 1})
    assert [tuple(r) for r in records["x"].collect()] == [(0, 1, 2)]
    assert rejects.first()["reason"] == "type of field a is not readable"


def test_several_names_in_one_log(spark):
    page = record(field("url", "string"), name="Page")
    registry = registry_of(spark, [*ITEMS, (2, "page", 1, page), (5, "other", 1, page)])
    bodies = [*BODIES[:2], (7, 2, '{"url":"u"}'), (8, 5, '{"url":"v"}')]
    records, rejects = decode(sealed(spark, bodies), registry, {"item": 3, "page": 1})
    assert [tuple(r) for r in records["page"].collect()] == [(7, "u")]
    assert sorted(r["offset"] for r in records["item"].collect()) == [0, 1]
    assert [tuple(r)[0::3] for r in rejects.collect()] == [(8, "no reader version")]


TWICE = record(field("sku", "string"), field("sku", "int"))
NAMELESS = record(field("sku", "string"), {"type": "int"})


@pytest.mark.parametrize("schema", [TWICE, NAMELESS, '"string"', "{", '{"type": "enum", "name": "e", "symbols": ["A"]}'])
def test_writer_schema_that_is_no_record(spark, schema):
    rows = [(3, "item", 1, schema, None), (4, "item", 3, V3, None)]
    registry = spark.createDataFrame(rows, REGISTRY)
    records, rejects = decode(sealed(spark, BODIES[:1]), registry, {"item": 3})
    assert records["item"].count() == 0
    assert rejects.first()["reason"] == "writer schema is not a record"


def test_all_names_from_one_read(spark):
    page = record(field("url", "string"), name="Page")
    registry = registry_of(spark, [*ITEMS, (2, "page", 1, page)])
    found = decode_all(sealed(spark, [*BODIES, (7, 2, '{"url":"u"}')]), registry, {"item": 2, "page": 1})
    rows = {r["offset"]: r for r in found.collect()}
    assert [rows[i]["name"] for i in (1, 7, 0)] == ["item", "page", None]
    assert tuple(rows[2]["record_0"]) == ("c3", None, 13) and rows[2]["record_1"] is None
    assert tuple(rows[7]["record_1"]) == ("u",) and rows[7]["record_0"] is None
    assert sum(r["reason"] is not None for r in rows.values()) == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_several_writers_register_at_once(spark, tmp_path):
    path = f"{tmp_path}/registry"
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: register_schema(spark, path, "item", i, V1)["id"], range(4)))
    assert sorted(got) == [0, 1, 2, 3]
    assert sorted((r["id"], r["version"]) for r in read_registry(spark, path).collect()) == sorted((k, v) for v, k in enumerate(got))
    # An id that a writer claimed before it broke off is not given again.
    assert claim(spark, f"{path}/_claims/{4:010d}", "gone")
    assert register_schema(spark, path, "item", 9, V2)["id"] == 5


def test_strict_mode_fails(spark):
    registry = registry_of(spark, ITEMS)
    records, _ = decode(sealed(spark, BODIES[1:3]), registry, {"item": 2}, strict=True)
    assert records["item"].count() == 2
    for bad in (BODIES[0], BODIES[3], BODIES[4]):
        records, _ = decode(sealed(spark, [bad]), registry, {"item": 2}, strict=True)
        with pytest.raises(Exception, match="message without a record"):
            records["item"].collect()


def test_missing_reader_version_is_an_error(spark):
    with pytest.raises(SchemaNotFound):
        decode(sealed(spark), registry_of(spark, ITEMS), {"item": 99})


def test_reader_fields_refuse_what_they_cannot_read():
    with pytest.raises(ValueError):
        reader_fields('"string"')
    with pytest.raises(ValueError):
        reader_fields(record(field("a", ["int", "string"])))
    with pytest.raises(ValueError):
        reader_fields(record(field("a", {"type": "array", "items": "int"})))


def test_big_registry_joins_without_broadcast(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr("brooklet.operators.evolve.BROADCAST_SCHEMAS", 1)
    try:
        good, bad = outcome(spark, 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(good) == [1, 2] and sorted(bad) == [0, 3, 4, 5, 6]


def test_avro_bodies_take_one_branch_per_writer(spark, monkeypatch):
    """The branches and the rest, with a JSON decoder in the place of the Avro one."""
    from pyspark.sql import functions as F
    from pyspark.sql.avro import functions as avro

    from brooklet.functions.avro_schema import reader_struct
    from brooklet.operators.evolve import decode_avro

    seen = []

    def from_json(body, writer, options):
        seen.append(writer)
        return F.from_json(body.cast("string"), reader_struct(reader_fields(options["avroSchema"])))

    monkeypatch.setattr(avro, "from_avro", from_json)
    records, others = decode_avro(sealed(spark, BODIES[:4]), registry_of(spark, ITEMS), "item", 3)
    assert sorted(seen) == sorted([V1, V2, V3])
    assert sorted(r["offset"] for r in records.collect()) == [0, 1, 2]
    assert [(r["offset"], r["schema_id"]) for r in others.collect()] == [(3, 6)]


def test_messages_that_are_no_records_are_kept_apart(spark):
    from brooklet.operators.registry import registry_rejects

    rows = [(0, b'{"id": 1, "name": "a"}'), (1, b"{broken"), (2, b'{"name": "a"}'), (3, None)]
    found = registry_rejects(spark.createDataFrame(rows, "offset int, value binary")).collect()
    assert [(r["offset"], r["reason"]) for r in found] == [(1, "not JSON"), (2, "no id"), (3, "no value")]
