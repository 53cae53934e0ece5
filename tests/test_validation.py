from __future__ import annotations

import json

import pytest

from tests.data import at, rows_of
from tickloom import schemas
from tickloom.operators import reconcile, validation
from tickloom.sources import messages

FIELDS = "id string, symbol string, current_price double"


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize(
    "record, reason",
    [
        (("a", "A", 1.5), None),
        ((None, "A", 1.5), "Missing required fields: ['id']"),
        ((None, None, None), "Missing required fields: ['id', 'symbol', 'current_price']"),
        ((None, "A", -1.0), "Missing required fields: ['id']"),
        (("a", "A", 0.0), "Invalid price: 0.0"),
        (("a", "A", -2.5), "Invalid price: -2.5"),
        (("a", "A", float("nan")), "Invalid price: NaN"),
    ],
)
def test_reasons(spark, record, reason):
    quotes = spark.createDataFrame([record], FIELDS)
    assert validation.with_reason(quotes).first().reason == reason
    letters = validation.dead_letters(quotes, "r1", at(0))
    assert [r.error_message for r in letters.collect()] == ([reason] if reason else [])
    assert validation.valid_quotes(quotes).count() == (0 if reason else 1)


@pytest.mark.parametrize(
    "price, reason",
    [
        ("1.5", None),
        ("3", None),
        ("1e-7", None),
        ('"12"', "Invalid price: 12"),
        ('"abc"', "Invalid price: abc"),
        ("true", "Invalid price: true"),
        ("0", "Invalid price: 0"),
        ("-1.25", "Invalid price: -1.25"),
        ("null", "Missing required fields: ['current_price']"),
    ],
)
def test_landed_prices(spark, price, reason):
    text = '[{"id": "a", "symbol": "A", "current_price": %s, "other": [1]}]' % price
    landed = messages.landed_quotes(lines(spark, text))
    row = validation.with_reason(landed).first()
    assert row.reason == reason
    if reason is None:
        assert row.current_price == float(price)


def test_letters_keep_the_whole_record(spark):
    text = '[{"id": null, "symbol": "A", "current_price": 2, "extra": {"k": [1, 2]}}]'
    landed = messages.landed_quotes(lines(spark, text))
    letter = validation.dead_letters(landed, "r", at(0), landed["payload"]).first()
    assert json.loads(letter.payload) == json.loads(text)[0]


def test_projection_keeps_the_named_fields(spark):
    quotes = spark.createDataFrame([("a", "A", 1.0, 9)], FIELDS + ", other int")
    out = validation.project_quote(quotes)
    assert out.columns == schemas.QUOTE.fieldNames()
    assert out.first().market_cap is None


def test_batch_guard(spark):
    rows = [("x", "a", "A", 1.0)] * 3 + [("y", None, "A", 1.0)]
    quotes = spark.createDataFrame(rows, "batch string, " + FIELDS)
    out = validation.batch_guard(quotes, ["batch"], expected=2).orderBy("batch")
    assert rows_of(out) == [
        ("x", 3, 3, False, None),
        ("y", 1, 0, True, validation.NONE_VALID),
    ]


def test_empty_or_invalid_batches_fail(spark):
    none = spark.createDataFrame([], FIELDS)
    bad = spark.createDataFrame([(None, "A", 1.0)], FIELDS)
    for quotes, text in ((none, validation.EMPTY_BATCH), (bad, validation.NONE_VALID)):
        with pytest.raises(ValueError, match=text[:20]):
            validation.require_records(quotes)
    letter = validation.failed_batch_letter(spark, "r", "API request failed: x", at(0)).first()
    assert (letter.payload, letter.error_message) == (None, "API request failed: x")


def test_responses_must_be_lists(spark):
    out = messages.response_guard(lines(spark, "[1, 2]", "[]", '{"a": 1}', "oops"))
    assert rows_of(out) == [(True, 2), (True, 0), (False, 0), (False, 0)]


def test_flatten_drops_what_has_no_records_and_unreadable_keeps_it(spark):
    good = '{"timestamp": "2024-01-01 00:00:00", "data": [{"id": "a", "current_price": 1, "market_cap": 1.5}, {"id": "b"}]}'
    texts = [good, "no json", '{"timestamp": "2024-01-01 00:00:00", "data": []}', '{"timestamp": "x"}']
    feed = lines(spark, *texts)
    out = messages.flatten(feed)
    assert out.columns == schemas.TICK_RAW.fieldNames()
    assert rows_of(out.orderBy("id"), "id", "price", "market_cap") == [("a", 1.0, None), ("b", None, None)]
    assert {r.payload for r in messages.unreadable(feed).collect()} == {"no json", '{"timestamp": "x"}'}


def test_ticks_with_bad_times_get_no_date(spark):
    raw = spark.createDataFrame([("2024-01-02 03:04:05", 1.0), ("soon", 1.0)], "timestamp string, price double")
    out = messages.typed_ticks(raw)
    assert [str(r.dt) for r in out.collect()] == ["2024-01-02", "None"]


def test_a_batch_is_one_message_of_any_size(spark):
    rows = [(at(0), f"k{i}", "S", 1.0) for i in range(20_000)] + [(at(1), "k", "S", 1.0)]
    quotes = spark.createDataFrame(rows, "timestamp timestamp_ntz, " + FIELDS)
    sizes = messages.parsed_messages(messages.envelopes(quotes)).selectExpr("size(message.data) n")
    assert sorted(r.n for r in sizes.collect()) == [1, 20_000]


def test_a_caller_may_ask_for_numbered_parts(spark):
    rows = [(at(m), "same", "S", 1.0) for m in range(6) for _ in range(25)]
    quotes = spark.createDataFrame(rows, "timestamp timestamp_ntz, " + FIELDS)
    sent = messages.envelopes(quotes, most_records=10)
    assert sorted(rows_of(sent, "part")) == [(0,)] * 6 + [(1,)] * 6 + [(2,)] * 6
    sizes = messages.parsed_messages(sent).selectExpr("size(message.data) n")
    assert sorted(r.n for r in sizes.collect()) == [5] * 6 + [10] * 12
    assert messages.flatten(sent).count() == len(rows)


def test_reconcile_reports_either_side(spark):
    sent = spark.createDataFrame([("a", 2), ("b", 1)], "run_id string, records_pushed int")
    landed = spark.createDataFrame([("a",), ("a",), ("c",)], "run_id string")
    out = reconcile.reconcile(sent, landed).orderBy("run_id")
    assert rows_of(out) == [("a", 2, 2, 0, True), ("b", 1, 0, 1, False), ("c", 0, 1, -1, False)]


def _message(offset, text):
    return ("ticks", 0, offset, text)


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([], (0, None, reconcile.NO_MESSAGES)),
        ([_message(1, "x"), _message(2, '{"timestamp": "t", "data": [{"id": "a"}]}')], (1, 1, None)),
        ([_message(2, "x")], (1, None, reconcile.BAD_SHAPE)),
    ],
)
def test_delivery_check(spark, rows, expected):
    feed = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    assert tuple(reconcile.verify_delivery(feed).first()) == expected
