import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from rows import trade, trades, ts

from tradelake import dims, enrich, keys, marts

VERSION = ("instrument_id string, instrument_name string, asset_class string, sector string, "
           "is_active boolean, valid_from timestamp, valid_to timestamp")


def instruments(spark):
    return spark.createDataFrame([
        ("I1", "one", "FX", "old", False, ts(2), ts(10)),
        ("I1", "one", "FX", "new", True, ts(10), None),
        ("I2", "two", "RATES", "s", True, ts(1), None)], VERSION)


def facts(spark):
    days = [1, 2, 9, 10, 20]
    rows = [trade(f"t{d}", trade_date=dt.date(2024, 1, d)) for d in days]
    return trades(spark, *rows, trade("none", instrument_id="I9"), trade("nil", instrument_id=None))


def test_asof_bounds_for_broadcast_and_shuffle(spark):
    for small in (True, False):
        got = enrich.asof_dim(facts(spark), instruments(spark), "instrument_id", "trade_date",
                              ["sector"], small=small)
        assert {r.trade_id: r.sector for r in got.collect()} == {
            "t1": None, "t2": "old", "t9": "old", "t10": "new", "t20": "new", "none": None,
            "nil": None}


def test_current_version(spark):
    got = enrich.current_dim(facts(spark), instruments(spark), "instrument_id", ["sector"])
    assert {r.sector for r in got.collect() if r.instrument_id == "I1"} == {"new"}
    assert got.count() == 7


def test_lookup_broadcasts_by_bytes_without_a_job(spark, new_path):
    path = new_path("dim")
    enrich.current(instruments(spark)).write.parquet(path)
    dim = spark.read.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookups", "")
    try:
        for threshold, join in (("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            got = enrich.enrich_batch(facts(spark), dim)
            assert not tracker.getJobIdsForGroup("lookups")
            plan = got._jdf.queryExecution().toString()
            assert join in plan[plan.index("== Physical Plan =="):]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got.count() == 7


def test_stream_lookup_stand_in_name(spark):
    cps = spark.createDataFrame([("L1", "bank")], "lei_code string, counterparty_name string")
    got = enrich.enrich_stream(facts(spark), instruments(spark), cps).collect()
    names = {r.trade_id: (r.instrument_name, r.counterparty_name) for r in got}
    assert names["t1"] == ("one", "bank") and names["none"] == ("INSTRUMENT_I9", "bank")


def test_scd2_null_attribute_is_a_state(spark):
    df = spark.createDataFrame([("k", ts(1), None), ("k", ts(2), None), ("k", ts(3), "x")],
                               "k string, changed_at timestamp, v string")
    got = [(r.v, r.valid_from, r.is_active) for r in
           dims.build_scd2(df, "k", ["v"], sk="sk").orderBy("valid_from").collect()]
    assert got == [(None, ts(1), False), ("x", ts(3), True)]


def test_overlaps(spark):
    df = spark.createDataFrame(
        [("a", ts(1), ts(3)), ("a", ts(3), None), ("b", ts(1), ts(4)), ("b", ts(3), None),
         ("c", ts(1), ts(2)), ("c", ts(1), ts(2))],
        "k string, valid_from timestamp, valid_to timestamp")
    assert {r.k for r in dims.overlapping_versions(df, "k").collect()} == {"b", "c"}


def warehouse(spark):
    return {
        "instruments": instruments(spark),
        "traders": spark.createDataFrame(
            [("D1", "ann", "DESK", True, ts(1), None)],
            "trader_id string, trader_name string, desk string, is_active boolean, "
            "valid_from timestamp, valid_to timestamp"),
        "books": spark.createDataFrame([("B1", "book", "EU")],
                                       "book_id string, book_name string, region string"),
        "counterparties": spark.createDataFrame(
            [("L1", "bank", "A")], "lei_code string, counterparty_name string, "
                                   "credit_rating string"),
    }


def rates(spark):
    return spark.createDataFrame([("EUR", dt.date(2024, 1, 10), Decimal("1.100000"))],
                                 "currency string, rate_date date, usd_rate decimal(12,6)")


def test_fact(spark):
    day = dt.date(2024, 1, 10)
    df = trades(spark, trade("eur", currency="EUR", trade_date=day), trade("usd", trade_date=day),
                trade("nil", currency=None, trade_date=day))
    for mode in ("asof", "current"):
        rows = {r.trade_id: r for r in
                marts.build_fct_trades(df, warehouse(spark), rates(spark), mode).collect()}
        assert len(rows) == 3
        assert rows["eur"].notional_usd == Decimal("11.0000")
        assert rows["usd"].notional_usd is None  # d10: no implicit rate
        assert (rows["eur"].sector, rows["eur"].desk, rows["eur"].region,
                rows["eur"].credit_rating) == ("new", "DESK", "EU", "A")


def test_d11_surrogate_key(spark):
    import hashlib
    row = spark.createDataFrame([("a", None)], "x string, y int").select(
        keys.surrogate_key("x", "y").alias("k")).first()
    assert row.k == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_d07_incremental(spark):
    source = trades(spark, trade("a", at=ts(1)), trade("b", at=ts(5)), trade("c", at=ts(6)))
    target = source.filter("trade_id = 'b'")

    def ids(df):
        return sorted(r.trade_id for r in df.collect())

    assert ids(marts.incremental_slice(source, target)) == ["c"]
    assert ids(marts.incremental_slice(source, target.limit(0))) == ["a", "b", "c"]
    assert ids(marts.incremental_slice(source, None)) == ["a", "b", "c"]
    assert ids(marts.incremental_slice(source, target, lookback="1 day")) == ["b", "c"]
    timeless = source.withColumn("updated_at", F.when(F.col("trade_id") != "a", F.col("updated_at")))
    assert ids(marts.incremental_slice(timeless, target)) == ["a", "c"]


def test_d27_daily_pnl(spark):
    day = dt.date(2024, 1, 10)
    fact = marts.build_fct_trades(
        trades(spark, trade("a", currency="EUR", trade_date=day),
               trade("b", currency="EUR", trade_date=day, status="CANCEL"),
               trade("c", instrument_id="I9", trade_date=day)),
        warehouse(spark), rates(spark))
    rows = {r.asset_class: r for r in marts.build_daily_pnl(fact).collect()}
    assert rows["FX"].trade_count == 2 and rows["FX"].total_notional_usd == Decimal("22.0000")
    assert rows[None].trade_count == 1 and rows[None].realized_pnl_usd is None  # d32
    few = marts.build_daily_pnl(fact, F.col("notional_usd"), ["CANCEL"]).filter("asset_class='FX'")
    assert (few.first().trade_count, few.first().realized_pnl_usd) == (1, Decimal("11.0000"))
