"""Messages and times that are not what they should be."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cartstream.functions import event_time, event_time_text, full_location, order_total, state_of
from cartstream.operators.parse import MALFORMED, OK, parse_messages, parsed_table
from cartstream.schemas import (
    CLICKSTREAM,
    DOUBLE,
    INT,
    PRODUCT,
    STRING,
    TIME,
    TRANSACTIONS,
    Topic,
    struct,
)

TIMES = [
    ("2025-01-01 10:00:00", dt.datetime(2025, 1, 1, 10)),
    ("2024-03-10 02:30:00", dt.datetime(2024, 3, 10, 2, 30)),
    ("2018-11-04 00:30:00", dt.datetime(2018, 11, 4, 0, 30)),  # gap in the tests' zone
    ("2024-02-29 23:59:59", dt.datetime(2024, 2, 29, 23, 59, 59)),
    ("2025-02-30 00:00:00", None),
    ("2025-1-1 00:00:00", None),
    ("2025-01-01", None),
    ("2025-01-01 25:00:00", None),
    ("2025-01-01T10:00:00", None),
    ("2025-01-01 10:00:00.5", None),
    ("2025-01-01 10:00:00\n", None),
    (" 2025-01-01 10:00:00", None),
    ("12025-1-01 10:00:00", None),
    ("2025-01-01 10:00:00Z", None),
    ("", None),
    (None, None),
]

SMALL = Topic("small", {"user_id": STRING, "amt": DOUBLE, "at": TIME}, time_column="at")

MESSAGES = [
    ('{"user_id":"a","amt":1}', [(OK, "a", 1.0, None)]),
    ("{}", [(OK, None, None, None)]),
    (
        '{"user_id":"b","amt":"x"}',
        [
            (OK, "b", None, None),
            (MALFORMED, "b", None, '{"user_id":"b","amt":"x"}'),
        ],
    ),
    ("junk", [(MALFORMED, None, None, "junk")]),
    ("null", [(MALFORMED, None, None, "null")]),
    ('[{"user_id":"z"}]', [(MALFORMED, None, None, '[{"user_id":"z"}]')]),
    ('{"user_id":"c"', [(MALFORMED, None, None, '{"user_id":"c"')]),
    ("", [(MALFORMED, None, None, "")]),
    (None, [(MALFORMED, None, None, None)]),
    ('{"user_id":"d","other":[1,2]}', [(OK, "d", None, None)]),
    ('{"user_id":null,"amt":null}', [(OK, None, None, None)]),
]


@pytest.fixture()
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "America/Sao_Paulo", "Asia/Kolkata"])
def test_event_times_do_not_depend_on_the_zone(spark, zone, name):
    zone(name)
    frame = spark.createDataFrame([(text,) for text, _ in TIMES], "t string")
    got = frame.select("t", event_time(F.col("t")).alias("at")).collect()
    assert [(row.t, row.at) for row in got] == TIMES
    assert frame.select(event_time(F.col("t")).alias("at")).schema["at"].dataType == TIME


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 12, 31)),
        min_size=1,
        max_size=50,
    )
)
def test_time_text_roundtrip(spark, times):
    frame = spark.createDataFrame([(time,) for time in times], "t timestamp_ntz")
    text = frame.select("t", event_time_text(F.col("t")).alias("text"))
    for row in text.select("t", "text", event_time(F.col("text")).alias("back")).collect():
        assert row.text == row.t.strftime("%Y-%m-%d %H:%M:%S").rjust(19, "0")
        assert row.back == row.t.replace(microsecond=0)


def test_malformed_messages(spark):
    messages = spark.createDataFrame([(text,) for text, _ in MESSAGES], "value string")
    for text, expected in MESSAGES:
        rows = parse_messages(messages.where(F.col("value").eqNullSafe(text)), SMALL).collect()
        got = [(row.status, row.user_id, row.amt, row.message) for row in rows]
        assert got == expected, text


def test_binary_and_text_envelopes_are_alike(spark):
    messages = spark.createDataFrame([(text,) for text, _ in MESSAGES], "value string")
    binary = messages.select(F.col("value").cast("binary"))
    as_text = parse_messages(messages, SMALL).collect()
    assert parse_messages(binary, SMALL).collect() == as_text


def test_keep_makes_every_message_one_row(spark):
    messages = spark.createDataFrame([(text,) for text, _ in MESSAGES], "value string")
    rows = parse_messages(messages, SMALL, on_malformed="keep").collect()
    assert len(rows) == len(MESSAGES)
    assert {row.status for row in rows} == {OK} and {row.message for row in rows} == {None}
    with pytest.raises(ValueError, match="on_malformed"):
        parse_messages(messages, SMALL, on_malformed="drop")


def test_bad_time_is_null_and_the_row_is_kept(spark):
    messages = spark.createDataFrame(
        [('{"user_id":"a","page":"/x","timestamp":"yesterday"}',)], "value string"
    )
    (row,) = parsed_table(messages, CLICKSTREAM).collect()
    assert (row.user_id, row.page, row.timestamp) == ("a", "/x", None)


def test_nested_products(spark):
    texts = [
        '{"transaction_id":"1","products":[{"product_id":"p","quantity":2,"unit_price":1.5}]}',
        '{"transaction_id":"2","products":[]}',
        '{"transaction_id":"3"}',
    ]
    messages = spark.createDataFrame([(text,) for text in texts], "value string")
    rows = {row.transaction_id: row.products for row in parsed_table(messages, TRANSACTIONS).collect()}
    assert [tuple(product) for product in rows["1"]] == [("p", 2, 1.5, None)]
    assert rows["2"] == [] and rows["3"] is None


def test_order_total(spark):
    schema = struct({"id": INT, "products": ArrayType(PRODUCT)})
    rows = [
        (1, [("a", 2, 10.01, "x"), ("b", 3, 0.333, "y")]),
        (2, []),
        (3, None),
        (4, [("a", None, 10.0, "x")]),
    ]
    frame = spark.createDataFrame(rows, schema)
    got = dict(frame.select("id", order_total(F.col("products"))).collect())
    assert got == {1: 21.02, 2: 0.0, 3: None, 4: None}


def test_locations(spark):
    frame = spark.createDataFrame(
        [("Pune, Maharashtra",), ("Pune",), ("A, B, C",), ("A,",), (",\tB ",), (None,)], "l string"
    )
    got = [row[0] for row in frame.select(state_of(F.col("l"))).collect()]
    assert got == ["Maharashtra", "", "B", "", "\tB", None]
    pairs = spark.createDataFrame([("Pune", "Goa"), ("Pune", None)], "c string, s string")
    joined = [row[0] for row in pairs.select(full_location(F.col("c"), F.col("s"))).collect()]
    assert joined == ["Pune, Goa", "Pune"]
