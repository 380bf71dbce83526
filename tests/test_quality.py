import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from rows import trade, trades, ts

from tradelake import envelope, marts, quality
from tradelake.schemas import FCT_TRADES, TRADES_RAW

BAD = {
    "trade_id_present": {"trade_id": None},
    "instrument_id_present": {"instrument_id": None},
    "notional_positive": {"notional": Decimal(0)},
    "currency_iso": {"currency": "usd"},
    "status_known": {"status": "PENDING"},
}


def test_each_rule_alone(spark):
    for rule, change in BAD.items():
        valid, invalid = quality.validate(trades(spark, trade(**change), trade()))
        assert valid.count() == 1
        row = invalid.first()
        assert row.failed_checks == [rule] and row.quarantine_reason == "FAILED_DQ_CHECK"


def test_negative_and_missing_amount_and_long_code(spark):
    df = trades(spark, trade(notional=Decimal(-1)), trade(notional=None), trade(currency="USDX"))
    got = sorted(r.failed_checks for r in quality.validate(df)[1].collect())
    assert got == [["currency_iso"], ["notional_positive"],
                   ["notional_present", "notional_positive"]]


def test_d02_null_currency_or_status_is_quarantined(spark):
    df = trades(spark, trade(currency=None), trade(status=None), trade())
    valid, invalid = quality.validate(df)
    assert (valid.count(), invalid.count()) == (1, 2)


def test_run_metrics_and_gate(spark):
    df = trades(spark, trade(), trade(currency=None), trade(status=None))
    valid, _ = quality.validate(df)
    assert tuple(quality.run_metrics(df).first()) == (1, 2)
    assert tuple(quality.backlog_gate(df, valid, 2).first()) == (3, 1, 2, True)
    assert tuple(quality.backlog_gate(df, valid, 1).first()) == (3, 1, 2, False)


def test_observed_counts_during_the_write(spark, new_path):
    df, seen = quality.observed(trades(spark, trade(), trade()))
    df.write.parquet(new_path())
    assert seen.get["rows"] == 2


def test_suite(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", -1, "X"), (None, 2, "usd"), (None, None, "USD")],
        "k string, n int, c string")
    checks = [quality.unique("k"), quality.unique_combination("k", "k"),
              quality.not_null("k"), quality.not_null("k", where=F.col("n") > 1),
              quality.at_least("n", 0), quality.accepted_values("c", ["USD", "X"]),
              quality.matches("c", "^[A-Z]{3}$"), quality.max_length("c", 2),
              quality.holds("d29_null_passes", F.col("n") > 0)]
    got = [(r.failures, r.status) for r in quality.run_suite(df, checks).collect()]
    # row checks first, then uniqueness checks
    assert got == [(2, "fail"), (1, "fail"), (1, "fail"), (1, "fail"), (2, "fail"), (2, "fail"),
                   (1, "fail"), (1, "fail"), (2, "fail")]


def test_checks_from_schema():
    names = [c.name for c in quality.checks_from_schema(FCT_TRADES, "trade_sk")]
    assert "not_null_trade_date" in names and "max_length_currency" in names
    assert names[-1] == "unique_trade_sk"
    assert quality.checks_from_schema(TRADES_RAW, ["trade_id", "event_type"])[-1].unique == (
        "trade_id", "event_type")


def test_judged_rows_are_split_alike(spark):
    df = trades(spark, trade(), trade("T2", currency=None), trade("T3", status="PENDING"), trade("T4", notional=None))
    plain, early = quality.validate(df), quality.validate(quality.judged(df))
    for a, b in zip(plain, early):
        assert a.columns == b.columns and sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_marks_give_the_verdicts_of_the_columns(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", -1, "X"), (None, 2, "usd"), (None, None, "USD")], "k string, n int, c string")
    checks = [quality.unique("k"), quality.not_null("k"), quality.not_null("k", where=F.col("n") > 1), quality.at_least("n", 0),
              quality.accepted_values("c", ["USD", "X"]), quality.matches("c", "^[A-Z]{3}$"), quality.max_length("c", 2),
              quality.not_null("c"), quality.holds("positive", F.col("n") > 0)]
    checks += [quality.max_length("n", i) for i in range(1, 80)]  # more than a number has bits
    want = quality.run_suite(df, checks).collect()
    marked = df.withColumn(quality.MARKS, quality.marks(checks, ["k", "n", "c"]))
    assert quality.run_suite(marked, checks, ["k", "n", "c"]).collect() == want
    without = marked.withColumn("c", F.lit("columns that have marks are not read"))
    assert quality.run_suite(without, checks, ["k", "n", "c"]).collect() == want
    nothing = df.select(*[F.lit(None).cast(t).alias(c) for c, t in df.dtypes])
    got = nothing.select(quality.marks(checks, ["k", "c"]).alias("a"), quality.null_marks(checks, ["k", "c"]).alias("b")).first()
    assert got.a == got.b == (1 << 1) + (1 << 7)


def test_unique_keys_stay_apart_when_packed(spark):
    """Hex digits move as bytes; other texts, upper case, odd lengths and what the bytes spell are keys of their own."""
    texts = ["6162", "ab", "AB", "0ab", "0abc", "h61", "a", "", "616", "t", "é", "zz", None, None]

    def failures(rows):
        return quality.run_suite(spark.createDataFrame([(t,) for t in rows], "k string"), [quality.unique("k")]).first().failures

    assert failures(texts) == 0
    assert failures([*texts, "6162", "AB", "", "", "é", "0ab"]) == 5


def _dims(spark, long):
    """A counterparty with a name too long, twice; a book and an instrument nobody looks up."""
    day = ts(1).replace(year=2020)
    version = "is_active boolean, valid_from timestamp, valid_to timestamp"
    return {
        "instruments": spark.createDataFrame([("I1", "x", None, "s" * long, True, day, None), ("I9", "x" * 300, "FX", "s", True, day, None)],
                                             f"instrument_id string, instrument_name string, asset_class string, sector string, {version}"),
        "traders": spark.createDataFrame([("D1", "n", "d" * long, True, day, None)], f"trader_id string, trader_name string, desk string, {version}"),
        "books": spark.createDataFrame([("B9", "b" * 300, "r" * 300)], "book_id string, book_name string, region string"),
        "counterparties": spark.createDataFrame([("L1", "c" * long, "A"), ("L1", "c", None)], "lei_code string, counterparty_name string, credit_rating string"),
    }


def test_fact_with_marks_is_checked_alike_and_moves_no_text(spark):
    rows = trades(spark, trade("T1"), trade("T2", counterparty_lei="L2", trader_id=None), trade("T3", book_id="b" * 60, trade_date=None),
                  trade("T4", instrument_id="I8", currency="EURO"), trade(None), trade("T6", event_type=None, counterparty_lei=None))
    dims = _dims(spark, 201)
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 1), Decimal(1))], "currency string, rate_date date, usd_rate decimal(12,6)")
    fields = [f for f in FCT_TRADES.fields if f.name in marts.FACT_COLUMNS]
    schema = [c for c in quality.checks_from_schema(type(FCT_TRADES)(fields), "trade_sk")]
    for checks in (schema, [*quality.fct_trades_checks(), quality.not_null("book_name"), quality.not_null("asset_class"), quality.not_null("desk")]):
        for mode in ("asof", "current"):
            want = quality.run_suite(marts.build_fct_trades(rows, dims, fx, mode), checks).collect()
            fact = marts.build_fct_trades(rows, dims, fx, mode, checks)
            assert quality.run_suite(fact, checks, marts.MARKED_COLUMNS).collect() == want
            assert {r.test for r in want if r.failures} > {"unique_trade_sk"}
            assert fact.columns == [*marts.FACT_COLUMNS, quality.MARKS]
    want = {r.test: r.failures for r in quality.run_suite(marts.build_fct_trades(rows, dims, fx), schema).collect()}
    assert want["max_length_counterparty_name"] == 4 and want["max_length_book_id"] == 2 and want["unique_trade_sk"] == 4


def test_checked_facts_move_neither_names_nor_amounts_and_short_keys(spark):
    """What is moved by the schema's checks: of texts that are only measured none goes through a shuffle."""
    import re

    from tradelake.plans.queries import QUERIES
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for name, value in zip(before, ("-1", "false")):
            spark.conf.set(name, value)
        plan = QUERIES["dq_fact_schema_constraints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    above = plan[:plan.index("Window [")]  # from the newest rows on
    joins = [line for line in above.splitlines() if re.match(r"\W*Project ", line)]
    trades_side = [line.split("Project", 1)[1] for line in joins if "_marks" in line]
    assert len(trades_side) >= 5
    assert not [line for line in trades_side if re.search(r"notional|status|counterparty_name|instrument_name|trader_name", line)]


def test_freshness_limits(spark):
    df = trades(spark, trade(at=ts(1)))

    def status(now):
        return quality.freshness(df, "updated_at", now, 12, 24).first().status

    assert status(ts(1, 12)) == "pass"
    assert status(ts(1, 13)) == "warn"
    assert status(ts(2, 0)) == "warn"
    assert status(ts(2, 1)) == "error"
    empty = quality.freshness(df.limit(0), "updated_at", ts(1), 12, 24).first()
    assert empty.status == "error" and empty.max_loaded_at is None


def test_mandatory_keys(spark):
    df = trades(spark, trade(), trade(trade_id=None), trade(instrument_id=None))
    ok, dead = envelope.split_publishable(df)
    assert (ok.count(), dead.count()) == (1, 2)
    assert {r.key for r in envelope.dead_letter_messages(dead).collect()} == {None, "T1"}


def test_envelope_keeps_nulls_headers_and_order(spark):
    rows = [("t2", "i", 2, "c2"), ("t1", "i", 1, "c1"), ("t3", "j", 0, None)]
    df = spark.createDataFrame(rows, "trade_id string, instrument_id string, event_ts int, "
                                     "correlation_id string")
    got = envelope.trade_messages(df, "SYS").collect()
    mine = [r.value for r in got if r.key == "i"]
    assert mine == ['{"trade_id":"t1","instrument_id":"i","event_ts":1}',
                    '{"trade_id":"t2","instrument_id":"i","event_ts":2}']
    heads = {h.key: h.value for h in got[0].headers}
    assert heads["sourceSystem"] == b"SYS" and heads["schemaVersion"] == b"v1"
    plain = envelope.to_keyed(spark.createDataFrame([("a", None)], "k string, v date"), "k").first()
    assert plain.value == '{"k":"a","v":null}' and plain.headers == []


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2019, 12, 31),), (dt.date(2020, 1, 1),)], "d date")
    assert quality.run_suite(df, [quality.on_or_after("d", "2020-01-01")]).first().failures == 1


def test_rates_made_by_an_aggregate_do_not_move_the_trades(spark):
    """Forty tasks make the same 2,000 rates: their parts are above the broadcast limit, the rates below."""
    days = spark.range(0, 80000, 1, 40).select(F.when(F.col("id") >= 0, "USD").alias("currency"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 2000).cast("int")).alias("rate_date"))
    fx = days.distinct().withColumn("usd_rate", F.lit(1).cast("decimal(12,6)"))
    rows = trades(spark, trade("T1"), trade("T2", currency="EUR"), trade("T3", trade_date=None))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "500k")
    try:
        fact = marts.build_fct_trades(rows, _dims(spark, 20), fx).select("trade_id", "notional_usd")
        got = {(r.trade_id, r.notional_usd) for r in fact.collect()}
        plan = fact._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {("T1", Decimal("10.0000")), ("T2", None), ("T3", None)}
    lookups = [line for line in plan.splitlines() if "Join" in line and "currency#" in line]
    assert lookups and all("BroadcastHashJoin" in line for line in lookups)
