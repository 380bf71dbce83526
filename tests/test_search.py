import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import trade, trades, ts

from tradelake import search
from tradelake.schemas import TRADE_ROW

TYPES = ["NEW", "AMEND", "SETTLE"]


@pytest.fixture(scope="module")
def fact(spark):
    rows = [trade(f"T{i:03d}", TYPES[i % 3] if j else "CANCEL", at=ts(1 + (i + j) % 9),
                  trade_date=dt.date(2024, 1, 1 + i % 10), instrument_id=f"I{i % 3}",
                  status=TYPES[i % 3], book_id=f"B{i % 2}", notional=Decimal(i))
            for i in range(60) for j in range(2)]
    df = trades(spark, *rows)
    extra = {c: F.lit("x") for c in ("instrument_name", "asset_class", "desk", "book_name",
                                     "counterparty_name", "credit_rating", "region")}
    return df.withColumns({**extra, "notional_usd": F.col("notional")}).cache()


RANGE = ("2024-01-01", "2024-01-31")


def keys(df):
    return [(r.trade_id, r.event_type) for r in df.collect()]


def everything(df):
    return sorted(keys(df.select("trade_id", "event_type")))


def test_pages_concatenate_to_the_full_result(fact):
    for limit in (1, 7, 60, 120, 1000):
        seen, cursor = [], None
        while True:
            row = search.search_connection(fact, *RANGE, limit=limit, cursor=cursor,
                                           fields=["trade_id", "event_type"]).first()
            seen += [(t.trade_id, t.event_type) for t in row.trades]
            assert row.page_info.page_count == len(row.trades)
            if not row.page_info.has_next_page:
                assert row.page_info.next_cursor is None
                break
            cursor = tuple(row.page_info.next_cursor)
            if limit == 1 and len(seen) > 4:
                break  # both events of a trade were split over two pages
        assert seen == everything(fact)[:len(seen)]
        assert limit == 1 or len(seen) == 120


def test_filters_and_fields(fact):
    got = search.search_trades(fact, "2024-01-02", "2024-01-02", status="AMEND", book_id="B1",
                               fields=["trade_id", "trade_date"])
    assert got.columns == ["trade_id", "trade_date"]
    assert {r.trade_date.day for r in got.collect()} == {2} and got.count() > 0
    assert search.search_trades(fact, *RANGE).columns == [*TRADE_ROW, "event_type"]


def test_d21_limits(fact):
    for bad in (0, -1, 1001):
        with pytest.raises(ValueError):
            search.search_trades(fact, *RANGE, limit=bad)
        with pytest.raises(ValueError):
            search.search_connection(fact, *RANGE, limit=bad)
        with pytest.raises(ValueError):
            search.search_trades_page(fact, *RANGE, size=bad)
    with pytest.raises(ValueError):
        search.search_trades_page(fact, *RANGE, page=-1)
    assert search.search_trades(fact, *RANGE, limit=1000).count() == 120


def test_offset_pages_near_and_deep(fact):
    full = everything(fact)
    for page, size in ((0, 10), (3, 7), (11, 10), (12, 10), (50, 10)):
        got = search.search_trades_page(fact, *RANGE, page=page, size=size)
        assert keys(got) == full[page * size:(page + 1) * size]


def test_deep_pages_are_found_by_counting_ranges(fact, monkeypatch):
    """Whatever a task may hold; with keys that a third of all rows share, and rows repeated very often."""
    odd = fact.withColumn("trade_id", F.when(F.crc32("trade_id") % 3 > 0, F.col("trade_id")))
    odd = odd.unionAll(odd.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("n"))
    columns = ["trade_id", "event_type", "notional", "status"]

    def pages(direct, size):
        monkeypatch.setattr(search, "DIRECT", direct)
        out, page = [], 0
        while True:
            got = [tuple(r) for r in search.search_trades_page(odd, *RANGE, page=page, size=size, fields=columns).collect()]
            if not got:
                return out
            out, page = out + got, page + 1

    at_once = pages(10_000, 45)
    assert len(at_once) == odd.count()
    assert pages(20, 45) == at_once
    assert sorted(at_once, key=str) == sorted((tuple(r) for r in odd.select(*columns).collect()), key=str)


def test_pages_write_nothing(spark, fact, monkeypatch):
    monkeypatch.setattr(search, "DIRECT", 20)
    before = sorted(os.walk(spark.conf.get("spark.checkpoint.dir")))
    search.search_trades_page(fact, *RANGE, page=0, size=10).collect()
    search.search_trades_page(fact, *RANGE, page=8, size=10).collect()
    assert sorted(os.walk(spark.conf.get("spark.checkpoint.dir"))) == before


def test_pages_keep_rows_without_id_or_type(fact):
    odd = fact.withColumns({
        "trade_id": F.when(F.col("trade_id") >= "T003", F.col("trade_id")),
        "event_type": F.when(F.col("event_type") != "CANCEL", F.col("event_type"))})
    full = sorted(keys(odd.select("trade_id", "event_type")),
                  key=lambda k: [(v is not None, v or "") for v in k])
    by_page = [keys(search.search_trades_page(odd, *RANGE, page=n, size=25)) for n in range(6)]
    assert sum(by_page, []) == full
    # a cursor cannot tell rows of one key apart, so one row of each key here
    once, seen, cursor = odd.dropDuplicates(["trade_id", "event_type"]), [], None
    while not seen or cursor:
        row = search.search_connection(once, *RANGE, limit=25, cursor=cursor,
                                       fields=["trade_id", "event_type"]).first()
        seen += [tuple(t) for t in row.trades]
        cursor = row.page_info.next_cursor and tuple(row.page_info.next_cursor)
    assert seen == list(dict.fromkeys(full))


def test_history_keeps_repeated_steps(spark):
    rows = trades(spark, trade("a", "NEW", at=ts(1)), trade("a", "AMEND", at=ts(2)),
                  trade("a", "AMEND", at=ts(3)), trade("b", "NEW", at=ts(1)), trade(None, "NEW"))
    life = {r.trade_id: [e.event_type for e in r.events] for r in search.trade_lifecycle(rows).collect()}
    assert life == {"a": ["NEW", "AMEND", "AMEND"], "b": ["NEW"]}
    assert [(r.trade_id, r.event_type) for r in search.lifecycle_steps(rows).collect()] == [
        ("a", "NEW"), ("a", "AMEND"), ("a", "AMEND"), ("b", "NEW")]
    assert search.lifecycle_steps(rows, ["b"]).count() == 1


def test_d18_zero_stays_zero(fact):
    rows = search.as_trade_rows(fact.filter("trade_id = 'T000'")).collect()
    assert {r.notional for r in rows} == {0.0}


def test_one_trade_and_its_history(fact):
    assert search.find_trade(fact, "nope").count() == 0
    row = search.find_trade(fact, "T004").collect()
    assert len(row) == 1 and row[0].event_type == "AMEND"
    life = search.trade_lifecycle(fact, ["T004"]).first()
    assert [e.event_type for e in life.events] == ["CANCEL", "AMEND"]
    assert search.trade_lifecycle(fact).count() == 60
    assert search.latest_state(fact).count() == 60


def test_recent_trades_per_instrument(fact):
    got = search.recent_trades(fact, "2024-01-09", days=2, limit=3).collect()
    assert {r.trade_date.day for r in got} <= {8, 9}
    for inst in ("I0", "I1", "I2"):
        mine = sorted((r for r in got if r.instrument_id == inst), key=lambda r: r.position)
        assert len(mine) == 3 and mine[0].trade_date.day == 9
    for bad in (0, 501):
        with pytest.raises(ValueError):
            search.recent_trades(fact, "2024-01-09", limit=bad)


def test_instruments_with_trades(spark, fact):
    dim = spark.createDataFrame(
        [("I0", "n", "FX", None, "USD", True), ("I9", "n", "FX", None, "USD", True),
         ("I1", "n", "FX", None, "USD", False)],
        "instrument_id string, instrument_name string, asset_class string, sector string, "
        "currency string, is_active boolean")
    got = {r.instrument_id: r.recent_trades for r in
           search.instruments_with_recent_trades(dim, fact, "2024-01-09", 9, 4).collect()}
    assert set(got) == {"I0", "I9"} and len(got["I0"]) == 4 and got["I9"] == []
    assert [t.position for t in got["I0"]] == [1, 2, 3, 4]
    assert search.find_instrument(dim, "I0").count() == 1
    assert search.find_instrument(dim, "I1").count() == 0
