from decimal import Decimal

from rows import trade, trades, ts

from tradelake import dedup

KEY = ["trade_id", "event_type"]


def test_newest_row_wins_and_duplicates_collapse(spark):
    df = trades(spark, trade(at=ts(1)), trade(at=ts(2), notional=Decimal(2)), trade(at=ts(1)),
                trade(event_type="AMEND"))
    got = {(r.event_type, r.notional) for r in dedup.latest(df, KEY).collect()}
    assert got == {("NEW", Decimal("2.0000")), ("AMEND", Decimal("10.0000"))}


def test_d01_tie_is_broken_by_the_other_columns(spark):
    rows = [trade(book_id="B2"), trade(book_id="B1"), trade(book_id="B3")]
    for order in (rows, rows[::-1]):
        assert [r.book_id for r in dedup.latest(trades(spark, *order), KEY).collect()] == ["B1"]


def test_null_time_loses(spark):
    df = trades(spark, trade(at=None, book_id="X"), trade(at=ts(1)))
    assert [r.book_id for r in dedup.latest(df, KEY).collect()] == ["B1"]


def test_d01_rows_without_key_all_stay(spark):
    df = trades(spark, trade(trade_id=None), trade(trade_id=None), trade(event_type=None), trade())
    assert dedup.latest(df, KEY).count() == 4
    assert dedup.latest(df, KEY, null_keys="drop").count() == 1


def test_as_of_sees_only_what_was_known(spark):
    df = trades(spark, trade(at=ts(1), book_id="old"), trade(at=ts(5), book_id="new"))
    assert [r.book_id for r in dedup.as_of(df, "2024-01-04").collect()] == ["old"]
    assert [r.book_id for r in dedup.as_of(df, "2024-01-05").collect()] == ["new"]


def test_one_exchange_and_a_limit_before_it(spark, new_path):
    path = new_path()
    trades(spark, trade()).write.parquet(path)
    df = spark.read.parquet(path)
    plan = dedup.latest(df, KEY, null_keys="drop")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning") == 1
    assert physical.count("WindowGroupLimit") == 2
