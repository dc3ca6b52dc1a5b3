import re

from clickloom.functions.temporal import temporals_as_text
from clickloom.sources.messages import dead_letters, encode, good_events, parse_messages
from test_enrich import plan_of

GOOD = ('{"customer_id": 7, "session_id": "s1", "event_name": "BOOKING", '
        '"event_time": "2024-01-01 10:00:00", "product_id": 12, "quantity": 2, '
        '"price_usd": 9.5, "unknown": [1]}')


def parse(spark, *values):
    return parse_messages(spark.createDataFrame([(v,) for v in values], "value STRING"))


def test_event_is_typed_and_missing_fields_are_null(spark):
    row = good_events(parse(spark, GOOD)).first()
    assert (row.customer_id, row.product_id, row.price_usd) == (7, 12.0, 9.5)
    assert str(row.event_time) == "2024-01-01 10:00:00"
    assert row.booking_id is None and row.event_id is None


def test_bytes_are_decoded(spark):
    rows = spark.createDataFrame([(bytearray(GOOD, "utf-8"),)], "value BINARY")
    assert good_events(parse_messages(rows)).count() == 1


def test_bad_messages_become_dead_letters(spark):
    bad_time = GOOD.replace("2024-01-01 10:00:00", "1 Jan")
    parsed = parse(spark, GOOD, "not json", bad_time, "[1, 2", "", None)
    assert good_events(parsed).count() == 1
    letters = dead_letters(parsed)
    assert {(r.raw, r.error) for r in letters.collect()} == {
        ("not json", "bad_json"), (bad_time, "bad_event_time"), ("[1, 2", "bad_json"),
        ("", "bad_json"), (None, "bad_json")}


def test_nan_is_null(spark):
    row = good_events(parse(spark, GOOD.replace("9.5", "NaN"))).first()
    assert row.price_usd is None and row.quantity == 2.0


def test_encode_and_parse_are_inverse(spark):
    first = good_events(parse(spark, GOOD))
    assert good_events(parse_messages(encode(first))).collect() == first.collect()


def test_temporals_as_text(spark):
    df = spark.sql("""SELECT DATE '2024-02-03' AS d, TIMESTAMP '2024-02-03 04:05:06' AS t,
        TIMESTAMP_NTZ '2024-02-03 04:05:06.7' AS n, 1 AS i""")
    assert tuple(temporals_as_text(df).first()) == (
        "2024-02-03 00:00:00", "2024-02-03 04:05:06", "2024-02-03 04:05:06", 1)


def test_time_of_day_as_text(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        df = spark.sql("SELECT TIME '04:05:06.7' AS h")
        assert temporals_as_text(df).first().h == "04:05:06"
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_numbers_are_taken_as_they_are_written(spark):
    loose = (GOOD.replace('"customer_id": 7', '"customer_id": 7.0').replace('"quantity": 2', '"quantity": "2"')
             .replace("10:00:00", "10:00:00.5"))
    row = good_events(parse(spark, loose)).first()
    assert (row.customer_id, row.quantity, str(row.event_time)) == (7, 2.0, "2024-01-01 10:00:00.500000")
    odd = good_events(parse(spark, GOOD.replace('"customer_id": 7', '"customer_id": "x"'))).first()
    assert odd.customer_id is None and odd.session_id == "s1"
    assert good_events(parse(spark, GOOD.replace('"s1"', '"a: NaN, b"'))).first().session_id == "a: NaN, b"


def test_only_objects_are_events(spark):
    assert {r.error for r in parse(spark, "5", "[1]", f"[{GOOD}]", '"x"', "null").collect()} == {"bad_json"}
    assert good_events(parse(spark, f"  {GOOD}")).count() == 1


def test_only_the_fields_in_use_are_taken_out(spark):
    plan = plan_of(good_events(parse(spark, GOOD)).select("session_id", "event_name"))
    taken = set(re.findall(r"try_variant_get\([^,]+, \$([^,]+),", plan))
    assert taken == {"['session_id']", "['event_name']", ".event_time"}
    assert plan.count("explode(") == 1
