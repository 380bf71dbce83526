import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import trade, trades, ts

from tradelake import jobs, session, sinks, sources
from tradelake.plans import marts
from tradelake.schemas import FACT_DATE_FLOOR

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def lake(spark, new_path):
    paths = {n: new_path(n) for n in ("raw", "instruments", "curated", "quarantine", "fact",
                                      "daily_pnl", "fx", "traders", "books", "counterparties")}
    spark.createDataFrame(
        [("I1", "one", "FX", "s", True, ts(1).replace(year=2020), None)],
        "instrument_id string, instrument_name string, asset_class string, sector string, "
        "is_active boolean, valid_from timestamp, valid_to timestamp"
    ).write.parquet(paths["instruments"])
    spark.createDataFrame(
        [("D1", "ann", "DESK", True, ts(1).replace(year=2020), None)],
        "trader_id string, trader_name string, desk string, is_active boolean, "
        "valid_from timestamp, valid_to timestamp").write.parquet(paths["traders"])
    spark.createDataFrame([("B1", "book", "EU"), ("B2", "two", "US")],
                          "book_id string, book_name string, region string"
                          ).write.parquet(paths["books"])
    spark.createDataFrame([("L1", "bank", "A")], "lei_code string, counterparty_name string, "
                          "credit_rating string").write.parquet(paths["counterparties"])
    spark.createDataFrame([("USD", DAY, Decimal(1)), ("USD", dt.date(2024, 1, 2), Decimal(2))],
                          "currency string, rate_date date, usd_rate decimal(12,6)"
                          ).write.parquet(paths["fx"])
    return paths


def land(df, paths, mode="append"):
    df.write.mode(mode).partitionBy("trade_date").parquet(paths["raw"])


def curated(spark, paths):
    return {(r.trade_id, r.event_type): r for r in spark.read.parquet(paths["curated"]).collect()}


def test_daily_run(spark, lake):
    land(trades(spark, trade("a", at=ts(1)), trade("a", at=ts(2), book_id="B2"), trade("b"),
                trade("c", currency=None), trade("d", event_type=None), trade(None), trade(None),
                trade("e", instrument_id="I9"), trade("z", trade_date=dt.date(2024, 1, 2))), lake)
    got = jobs.run_daily(spark, lake, DAY)
    assert (got["valid"], got["quarantined"]) == (3, 4)
    rows = curated(spark, lake)
    assert set(rows) == {("a", "NEW"), ("b", "NEW"), ("e", "NEW")}
    assert rows["a", "NEW"].book_id == "B2" and rows["a", "NEW"].asset_class == "FX"
    assert rows["e", "NEW"].asset_class is None
    bad = spark.read.parquet(lake["quarantine"])
    assert {(r.trade_id, r.quarantine_reason, tuple(r.failed_checks)) for r in bad.collect()} == {
        ("c", "FAILED_DQ_CHECK", ("currency_iso",)),
        ("d", "NULL_MERGE_KEY", ("merge_key_present",)),
        (None, "FAILED_DQ_CHECK", ("trade_id_present",))}
    assert bad.count() == 4 and "asset_class" not in bad.columns


def test_daily_run_again_changes_nothing(spark, lake):
    land(trades(spark, trade("a"), trade("c", currency=None)), lake)
    for _ in range(2):
        jobs.run_daily(spark, lake, DAY)
    assert set(curated(spark, lake)) == {("a", "NEW")}
    assert spark.read.parquet(lake["quarantine"]).count() == 1


def test_the_whole_run_and_its_gates(spark, lake):
    land(trades(spark, trade("a", at=ts(1)), trade("a", at=ts(2)), trade("b"), trade("c", currency=None)), lake)
    dim = spark.read.parquet(lake["instruments"]).withColumns({"instrument_sk": F.col("instrument_id"), "currency": F.lit("USD")})
    lake["instruments"] += "-2"
    dim.write.parquet(lake["instruments"])

    def run(now, **more):
        got = jobs.run_pipeline(spark, lake, DAY, "r1", now=now, **more).collect()
        return {(r.step, r.test): r.status for r in got}

    got = run(ts(2) + dt.timedelta(hours=13))
    assert got["gate", "backlog"] == "pass" and got["curated", "freshness"] == "warn" and got["instruments", "freshness"] == "error"
    assert {step for step, _ in got} == {"gate", "fct_trades", "dim_instruments", "daily_pnl", "curated", "instruments"}
    assert [k for k, v in got.items() if v == "fail"] == []
    assert run(ts(2) + dt.timedelta(hours=1))["curated", "freshness"] == "pass"
    assert run(ts(2), backlog_limit=-1) == {("gate", "backlog"): "fail"}


def test_warehouse_run_is_incremental(spark, lake):
    land(trades(spark, trade("a", at=ts(1)), trade("b", at=ts(2))), lake)
    jobs.run_daily(spark, lake, DAY)
    checks = {r.test: r.failures for r in jobs.run_warehouse(spark, lake, "r1").collect()}
    assert checks["unique_trade_sk"] == 0 and checks["not_null_notional"] == 0
    land(trades(spark, trade("a", "AMEND", at=ts(5), book_id="B2"),
                trade("b", at=ts(6), book_id="B2")), lake)
    jobs.run_daily(spark, lake, DAY)
    jobs.run_warehouse(spark, lake, "r2")
    fact = {(r.trade_id, r.event_type): r for r in spark.read.parquet(lake["fact"]).collect()}
    assert {k: (v.book_id, v.dbt_invocation_id) for k, v in fact.items()} == {
        ("a", "NEW"): ("B1", "r1"), ("a", "AMEND"): ("B2", "r2"), ("b", "NEW"): ("B2", "r2")}
    pnl = {(str(r.report_date), r.book_id): r for r in
           spark.read.parquet(lake["daily_pnl"]).collect()}
    assert {k: v.trade_count for k, v in pnl.items()} == {
        ("2024-01-01", "B1"): 1, ("2024-01-01", "B2"): 2}
    assert pnl["2024-01-01", "B2"].total_notional_usd == Decimal("20.0000")


def test_daily_pnl_region_that_vanishes(spark, new_path):
    path = new_path("pnl")
    df = spark.createDataFrame([(DAY, "B1", "EU", 1), (DAY, "B2", "US", 2)],
                               "report_date date, book_id string, region string, trade_count int")
    sinks.write_daily_pnl(df, path)
    sinks.write_daily_pnl(df.filter("region = 'EU'"), path, [DAY])
    assert [r.region for r in spark.read.parquet(path).collect()] == ["EU"]


def test_read_raw_prunes_to_the_date(spark, lake):
    land(trades(spark, trade("a"), trade("b", trade_date=dt.date(2024, 1, 2))), lake)
    df = sources.read_raw(spark, lake["raw"], DAY)
    assert [r.trade_id for r in df.collect()] == ["a"]
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan
    assert sources.read_raw(spark, lake["raw"]).count() == 0  # yesterday


def test_dim_reads_only_its_columns(spark, lake):
    df = sources.read_dim(spark, lake["books"], ["book_id"])
    assert "ReadSchema: struct<book_id:string>" in df._jdf.queryExecution().toString()


def test_derived_columns_are_not_moved(spark, new_path):
    df = trades(spark, *[trade(f"t{i}") for i in range(9)]).withColumn("usd_rate", F.lit(2)).withColumns(marts.derived_columns())
    for move in (lambda rows: sinks.sorted_layout(rows, ["trade_date"]), lambda rows: rows.hint("rebalance", 4, "trade_id")):
        got = sinks.moved(df, move, marts.derived_columns())
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("md5(") == 1 and plan.index("md5(") < plan.index("Repartition" if "Repartition" in plan else "Rebalance")
        assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    sinks.write_sorted(df, new_path("sorted"), ["trade_date"], late=marts.derived_columns())


def test_sorted_and_bucketed_layouts(spark, new_path):
    df = trades(spark, *[trade(f"t{i}") for i in range(50)])
    path = new_path("sorted")
    sinks.write_sorted(df, path, ["trade_date", "trade_id"])
    assert spark.read.parquet(path).count() == 50
    name = "bucketed_trades"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.write_bucketed(df, name, "trade_id", 4, path=new_path("bucketed"))
    table = spark.table(name)
    plan = table.groupBy("trade_id").count()._jdf.queryExecution().toString()
    assert "Exchange" not in plan[plan.index("== Physical Plan =="):]
    assert table.count() == 50


def test_hot_partition_is_written_by_several_tasks(spark, new_path):
    """One partition holds nearly all rows: rebalancing cuts it into several files."""
    path = new_path("hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
    df = spark.range(40000).select(
        F.md5(F.col("id").cast("string")).alias("trade_id"),
        F.when(F.col("id") < 39900, "FX").otherwise("RATES").alias("asset_class"),
        F.lit(DAY).alias("trade_date")).repartition(8)
    try:
        sinks.write_curated(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    table = spark.read.parquet(path).select("asset_class", "_metadata.file_path")
    files = table.filter("asset_class = 'FX'").select("file_path").distinct().count()
    assert files > 3 and table.count() == 40000


def test_shared_dir_is_the_configured_one(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
    assert FACT_DATE_FLOOR == "2020-01-01"


def test_union_of_different_columns(spark):
    got = sources.union_evolving(spark.range(1).toDF("a"), spark.range(1).toDF("b")).collect()
    assert [tuple(r) for r in got] == [(0, None), (None, 0)]
