"""Three-valued validation: all combinations, and the SQL meaning of each flag."""

from itertools import product

import pytest

from brooklet.operators.validate import flag_record, split, validate, with_route

DOMAINS = {"card_type": ["Credit", "Debit"], "event_state": ["CREATED", "SWIPED"]}
MEMBER = {True: 0, False: 1, None: 2}
CARDS = ["Credit", "Whatever", None]
STATES = ["SWIPED", "INVALID", None]


def kleene_and(*values):
    if False in values:
        return False
    return None if None in values else True


def cases():
    for present, card, state in product([True, False], [True, False, None], [True, False, None]):
        yield present, card, state


def frame(spark):
    rows = [
        (i, 7 if present else None, CARDS[MEMBER[card]], STATES[MEMBER[state]])
        for i, (present, card, state) in enumerate(cases())
    ]
    return spark.createDataFrame(rows, "id int, customer_id int, card_type string, event_state string")


def test_truth_table(spark):
    checked = validate(frame(spark), ["customer_id"], DOMAINS)
    got = {r["id"]: r for r in checked.collect()}
    assert len(got) == 18
    for i, (present, card, state) in enumerate(cases()):
        assert got[i]["mandatory_fields_exist"] is present
        assert got[i]["valid_card_type"] is card
        assert got[i]["valid_event_state"] is state
        assert got[i]["valid_record"] is kleene_and(present, card, state)


def test_split_and_route_cover_every_row_once(spark):
    checked = validate(frame(spark), ["customer_id"], DOMAINS)
    parts = split(checked)
    sizes = {name: part.count() for name, part in parts.items()}
    assert sizes == {"valid": 1, "invalid": 14, "undecided": 3}
    routed = {r["route"]: r["count"] for r in with_route(checked).groupBy("route").count().collect()}
    assert routed == sizes


def test_missing_field_beats_missing_card(spark):
    rows = spark.createDataFrame([(None, None, "SWIPED")], "customer_id int, card_type string, event_state string")
    assert split(validate(rows, ["customer_id"], DOMAINS))["invalid"].count() == 1


def test_text_timestamps(spark):
    rows = spark.createDataFrame([("2018-11-12",), ("nope",), (None,)], "event_timestamp string")
    checked = validate(rows, [], {}, "event_timestamp", "yyyy-MM-dd").collect()
    assert [r["correct_timestamp_format"] for r in checked] == [True, False, False]


def test_typed_timestamps_pass_through(spark):
    rows = spark.sql("SELECT timestamp'2018-11-12 09:42:00' AS event_timestamp")
    got = validate(rows, [], {}, "event_timestamp").first()
    assert got["parsed_event_timestamp"] == got["event_timestamp"] and got["valid_record"]


@pytest.mark.parametrize(
    ("card", "state", "expected"),
    [("Visa", "created", True), ("visa", "created", False), (None, "created", None), (None, "x", False)],
)
def test_flag_record(spark, card, state, expected):
    rows = spark.createDataFrame([(card, state)], "card_type string, event_state string")
    domains = {"card_type": ["Visa", "MasterCard"], "event_state": ["created"]}
    assert flag_record(rows, domains).first()["is_valid"] is expected
