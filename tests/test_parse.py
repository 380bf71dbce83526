import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradelake import parse

SEEN = dt.datetime(2024, 5, 1)
FULL = ('{"tradeId":"a","instrumentId":"i","notional":%s,"currency":%s,"eventTimestamp":%s}')


def run(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string").withColumn(
        "_record_ts", F.lit(SEEN))
    return parse.parse_events(df)


def one(spark, text):
    return run(spark, text).first()


@pytest.mark.parametrize("text, reason", [
    ("{bad", "Malformed JSON"), ("", "Malformed JSON"), (None, "Malformed JSON"),
    ('{"a":NaN}', "Malformed JSON"), ("[]", "Not a JSON object"), ("1", "Not a JSON object"),
    ("null", "Not a JSON object"),
    (FULL % (1, '"USD"', 1) + " trailing", "Malformed JSON"),
    (FULL % (1, '"USD"', 1) + ',"x":2', "Malformed JSON"),
    (FULL % ("null", '"USD"', 1), "Bad notional"), (FULL % ('"x"', '"USD"', 1), "Bad notional"),
])
def test_bad_events_keep_text_and_reason(spark, text, reason):
    row = one(spark, text)
    assert (row.valid, row.reason, row.raw) == (False, reason, text)


def test_each_missing_key_is_named(spark):
    import json
    full = json.loads(FULL % (1, '"USD"', 1))
    for key in full:
        text = json.dumps({k: v for k, v in full.items() if k != key})
        assert one(spark, text).reason == f"Missing fields: {{{key}}}"
    assert one(spark, "{}").reason == (
        "Missing fields: {currency, eventTimestamp, instrumentId, notional, tradeId}")


def test_d14_null_counts_as_present_and_own_flag_is_ignored(spark):
    row = one(spark, FULL % (1, "null", 1))
    assert row.valid and row.currency is None
    assert one(spark, (FULL % (1, '"USD"', 1))[:-1] + ',"valid":false}').valid


def test_amounts(spark):
    rows = run(spark, FULL % ('"100"', '"USD"', 1), FULL % ("1234567890123456.1234", '"USD"', 1),
               FULL % ("1e3", '"USD"', 1)).collect()
    assert [r.notional for r in rows] == [Decimal("100.0000"), Decimal("1234567890123456.1234"),
                                          Decimal("1000.0000")]


def test_d15_event_time_falls_back_to_record_time(spark):
    rows = run(spark, FULL % (1, '"USD"', "1704067200123"), FULL % (1, '"USD"', '"1704067200123"'),
               FULL % (1, '"USD"', '"soon"'), FULL % (1, '"USD"', "9e18")).collect()
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert [r.event_ts for r in rows] == [at, at, SEEN, SEEN]
    assert all(r.valid for r in rows)


def test_d31_optional_fields(spark):
    extra = ',"eventType":"AMEND","status":"NEW","updatedAt":1704067200000,"tradeDate":"2024-01-02"}'
    row = one(spark, (FULL % (1, '"USD"', 1))[:-1] + extra)
    assert (row.event_type, row.status, row.updated_at, row.trade_date) == (
        "AMEND", "NEW", dt.datetime(2024, 1, 1), dt.date(2024, 1, 2))
    plain = one(spark, FULL % (1, '"USD"', 1704067200000))
    assert plain.updated_at == plain.event_ts


def test_split_is_complete(spark):
    df = run(spark, "{bad", FULL % (1, '"USD"', 1), "[]")
    valid, invalid = parse.split_valid(df)
    assert (valid.count(), invalid.count()) == (1, 2)


def test_text_is_parsed_once(spark, new_path):
    path = new_path()
    spark.createDataFrame([("{}", SEEN)], "value string, _record_ts timestamp").write.parquet(path)
    valid, _ = parse.split_valid(parse.parse_events(spark.read.parquet(path)))
    plan = valid._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("parseJson") == 1 and "Python" not in physical
