"""Records to typed events, and the reasons for rejecting one."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from samples import SAMPLE, found, order, raw

from retailflow.functions.parsing import accepted, parse_events, rejected
from retailflow.schemas import columns


def reasons(spark, kind, values):
    parsed = parse_events(raw(spark, values), kind).select("reject_reason").collect()
    return [row[0] for row in parsed]


def without(name, kind="transactions"):
    return json.dumps({k: v for k, v in SAMPLE[kind].items() if k != name})


@pytest.mark.parametrize(
    "value",
    ["{not json", "[1]", "", None, "5", "null", "{}", '{"foo": 1}', '{"order_id": "o1", "price"'],
)
def test_unreadable(spark, value):
    for kind in SAMPLE:
        assert reasons(spark, kind, [value]) == ["unreadable"]


@pytest.mark.parametrize(
    "value, reason",
    [
        (order(), None),
        (order(quantity="3"), "invalid:quantity"),
        (order(quantity=2.5), "invalid:quantity"),
        (order(quantity=3.0), "invalid:quantity"),
        (order(quantity=True), "invalid:quantity"),
        (order(quantity={"n": 3}), "invalid:quantity"),
        (order(quantity=[3]), "invalid:quantity"),
        (order(quantity=None), "missing:quantity"),
        (order(quantity=-3), None),
        (order(quantity=3_000_000_000), "invalid:quantity"),
        (order(gift=True), None),
        (order(price=99999999999.1), "invalid:price"),
        (order(price="12.50"), None),
        (order(price="cheap"), "invalid:price"),
        (order(price=False), "invalid:price"),
        (order(price=1e300), "invalid:price"),
        (order(price=1e2), None),
        (order(price=None), "missing:price"),
        (order(postal_code="1" * 20), None),
        (order(postal_code="1" * 21), "too_long:postal_code"),
        (order(street="é" * 500), None),
        (order(street="é" * 501), "too_long:street"),
        (order(payment_method="x" * 101), "too_long:payment_method"),
        (order(timestamp="yesterday"), "invalid:timestamp"),
        (order(timestamp="2024"), "invalid:timestamp"),
        (order(timestamp="2024-03"), "invalid:timestamp"),
        (order(timestamp="08:00:00"), "invalid:timestamp"),
        (order(timestamp="2024-02-30T08:00:00"), "invalid:timestamp"),
        (order(timestamp="2024-03-01"), None),
        (order(timestamp="2024-03-01 08:00:00Z"), None),
        (order(timestamp=None), "missing:timestamp"),
        (
            order(user_email=None, quantity="x", order_id="o" * 256),
            "too_long:order_id,missing:user_email,invalid:quantity",
        ),
    ],
)
def test_transaction_rules(spark, value, reason):
    assert reasons(spark, "transactions", [value]) == [reason]


@pytest.mark.parametrize("name", columns("transactions"))
def test_every_transaction_field_is_required(spark, name):
    assert reasons(spark, "transactions", [without(name)]) == [f"missing:{name}"]


def test_optional_fields(spark):
    for kind, needed in (
        ("clickstream", {"event_id"}),
        ("inventory", {"event_id", "product_id", "change_type", "quantity_change"}),
    ):
        for name in columns(kind):
            expected = f"missing:{name}" if name in needed else None
            assert reasons(spark, kind, [without(name, kind)]) == [expected]
        late = json.dumps({**SAMPLE[kind], "timestamp": "soon"})
        assert reasons(spark, kind, [late]) == ["invalid:timestamp"]


def test_values(spark):
    values = [
        order(price=123.455, timestamp="2024-03-01T08:00:00+07:00"),
        order(price=500, timestamp="2024-03-01T08:00:00.123456+00:00"),
    ]
    rows = accepted(parse_events(raw(spark, values), "transactions"))
    assert rows.columns == columns("transactions")
    assert found(rows, "price", "timestamp") == [
        (Decimal("123.46"), datetime(2024, 3, 1, 1)),
        (Decimal("500.00"), datetime(2024, 3, 1, 8, 0, 0, 123456)),
    ]


def test_wrong_types_of_other_topics(spark):
    stock = {**SAMPLE["inventory"], "quantity_change": "many"}
    assert reasons(spark, "inventory", [json.dumps(stock)]) == ["invalid:quantity_change"]
    only = ['{"quantity": "x"}', '{"quantity": null}']
    found = reasons(spark, "transactions", only)
    assert "invalid:quantity" in found[0] and "missing:price" in found[0]
    assert found[1] == "unreadable"


def test_bytes_and_split(spark):
    values = [order(), "{not json", order(quantity=None)]
    binary = raw(spark, values).selectExpr("CAST(value AS BINARY) AS value")
    parsed = parse_events(binary, "transactions")
    assert accepted(parsed).count() == 1
    assert found(rejected(parsed)) == sorted(
        [("{not json", "unreadable"), (values[2], "missing:quantity")], key=repr
    )


def test_good_records_do_not_keep_their_text(spark):
    row = parse_events(raw(spark, [order()]), "transactions").first()
    assert row["value"] is None and row["reject_reason"] is None


def test_json_is_parsed_once(spark):
    parsed = parse_events(spark.range(10).selectExpr("CAST(id AS STRING) AS value"), "transactions")
    for frame in (parsed, accepted(parsed), rejected(parsed)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
