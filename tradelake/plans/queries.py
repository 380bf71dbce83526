"""Registered queries: every operator over the test tables (see README for the map)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake import fixtures, sinks, streaming
from tradelake.functions import envelope, keys, parse
from tradelake.operators import dedup, dims, enrich, maintenance, merge, quality, search, windows
from tradelake.plans import jobs, marts
from tradelake.schemas import (
    DIM_BOOKS,
    DIM_COUNTERPARTIES,
    DIM_FX_RATES,
    DIM_INSTRUMENTS,
    DIM_TRADERS,
    FCT_TRADES,
    MONEY,
    TRADE_KEY,
)
from tradelake.session import freed, scratch_path, stage
from tradelake.sources import confirmations, lake
from tradelake.sources.checksums import with_sha256 as checksums_of

QUERIES = {}
TIES = ["tie_part", "tie_supp"]
AVAILABLE = {"availableNow": True}
COMPACT_TASK_BYTES = 16 << 20
PACKED = "zstd"  # for tables between two steps


def query(fn):
    """Register ``fn(spark, sf_dir)`` under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


# --- Shared inputs -----------------------------------------------------------------

def _newest(spark, sf):
    return dedup.latest(fixtures.trades_raw(spark, sf), TRADE_KEY, "updated_at", TIES)


def _valid(spark, sf, checks=()):
    """Newest trades that pass; with ``checks`` they are judged and marked before they are moved."""
    if not checks:
        return quality.validate(_newest(spark, sf))[0]
    raw = quality.judged(fixtures.trades_raw(spark, sf)).withColumn(quality.MARKS, quality.marks(checks, marts.TRADE_COLUMNS))
    return quality.validate(dedup.latest(raw, TRADE_KEY, "updated_at", TIES))[0]


def _fact(spark, sf, mode="asof", checks=()):
    return marts.build_fct_trades(_valid(spark, sf, checks), fixtures.dims(spark, sf),
                                  fixtures.dim_fx_rates(spark, sf), mode, checks)


def _stored_trades(spark, sf):
    """The valid trades where all columns are asked for: stored, so that what was shuffled for them is freed before the lookups move them again."""
    return stage(_valid(spark, sf), "trades", PACKED)


def _whole_fact(spark, sf, mode="asof"):
    return marts.build_fct_trades(_stored_trades(spark, sf), fixtures.dims(spark, sf), fixtures.dim_fx_rates(spark, sf), mode)


def _checked_fact(spark, sf, checks):
    return quality.run_suite(_fact(spark, sf, checks=checks), checks, marts.MARKED_COLUMNS)


def _events(spark, sf):
    return parse.parse_events(fixtures.trade_events_json(spark, sf))


# --- Batch lane ----------------------------------------------------------------------

@query
def read_raw_by_date(spark, sf):
    return lake.for_date(fixtures.trades_raw(spark, sf), "1998-06-01").drop(*TIES)


@query
def read_raw_partition(spark, sf):
    """One date of a table partitioned by it."""
    path = scratch_path(spark, "raw")
    fixtures.trades_raw(spark, sf).drop(*TIES).repartition("trade_date").write.partitionBy("trade_date").parquet(path)
    return lake.read_raw(spark, path, "1998-06-01")


@query
def read_dim_columns(spark, sf):
    return lake.read_dim(spark, f"{sf}/part.parquet", ["p_partkey", "p_name", "p_type"])


@query
def dedup_latest(spark, sf):
    return _newest(spark, sf)


@query
def validate_valid(spark, sf):
    return _valid(spark, sf)


@query
def validate_invalid(spark, sf):
    invalid = quality.validate(_newest(spark, sf))[1]
    return invalid.withColumn("failed_checks", F.array_join("failed_checks", ","))


@query
def run_metrics(spark, sf):
    return quality.run_metrics(_newest(spark, sf))


@query
def enrich_instruments(spark, sf):
    current = enrich.current(fixtures.dim_instruments(spark, sf))
    return enrich.enrich_batch(_valid(spark, sf), current)


def _merge_sides(spark, sf):
    """Older trades as target; later ones, partly with an old time stamp, as source."""
    raw = fixtures.trades_raw(spark, sf)
    target = dedup.latest(raw.filter("updated_at < timestamp'1999-07-01'"), TRADE_KEY,
                          "updated_at", TIES)
    source = dedup.latest(raw.filter("updated_at >= timestamp'1998-01-01'"), TRADE_KEY,
                          "updated_at", TIES)
    shifted = F.col("updated_at") - F.expr("INTERVAL 200 DAYS")
    source = source.withColumns({
        "notional": (F.col("notional") + 1).cast(MONEY),
        "updated_at": F.when(F.col("event_type") == "SETTLE", shifted).otherwise(
            F.col("updated_at")),
    })
    return target, source


@query
def upsert_guarded(spark, sf):
    return merge.upsert(*_merge_sides(spark, sf))


@query
def upsert_unguarded(spark, sf):
    return merge.upsert(*_merge_sides(spark, sf), guard=None)


@query
def upsert_table(spark, sf):
    """The guarded merge through a stored table whose rows change partition."""
    target, source = _merge_sides(spark, sf)
    path = scratch_path(spark, "upsert-table")
    for rows in (target, source):
        merge.upsert_table(spark, path, rows, partitions=["status"], rebalance=False)
    return spark.read.parquet(path).select(*target.columns)


@query
def upsert_table_unguarded(spark, sf):
    """The merge in which the source always wins, through a stored table of a declared schema."""
    target, source = _merge_sides(spark, sf)
    path = scratch_path(spark, "upsert-unguarded")
    for rows in (target, source):
        merge.upsert_table(spark, path, rows, partitions=["status"], guard=None, schema=target.schema, rebalance=False)
    return spark.read.parquet(path).select(*target.columns)


@query
def trades_as_of(spark, sf):
    return dedup.as_of(fixtures.trades_raw(spark, sf), "1999-01-01 00:00:00", ties=TIES)


@query
def backlog_gate(spark, sf):
    return quality.backlog_gate(fixtures.trades_raw(spark, sf), _valid(spark, sf))


# --- Warehouse lane ----------------------------------------------------------------------

@query
def incremental_slice(spark, sf):
    raw = fixtures.trades_raw(spark, sf)
    return marts.incremental_slice(raw, raw.filter("updated_at < timestamp'2000-01-01'"))


@query
def incremental_slice_lookback(spark, sf):
    raw = fixtures.trades_raw(spark, sf)
    return marts.incremental_slice(raw, raw.filter("updated_at < timestamp'2000-01-01'"),
                                   lookback="30 days")


@query
def fct_trades(spark, sf):
    return _whole_fact(spark, sf)


@query
def fct_trades_current_dims(spark, sf):
    return _whole_fact(spark, sf, "current")


@query
def fct_trades_audited(spark, sf):
    audited = marts.with_audit(_fact(spark, sf), "run-1")
    return audited.groupBy("dbt_invocation_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("dbt_loaded_at").isNotNull()).alias("stamped"))


@query
def trade_surrogate_key(spark, sf):
    return _newest(spark, sf).select(keys.surrogate_key(*TRADE_KEY).alias("trade_sk"),
                                     keys.surrogate_key("trade_id", "status").alias("status_sk"),
                                     *TRADE_KEY)


@query
def dim_instruments_scd2(spark, sf):
    return dims.build_scd2(fixtures.instrument_changes(spark, sf), "instrument_id",
                           ["instrument_name", "asset_class", "sector", "currency"],
                           "changed_at", sk="instrument_sk")


@query
def trade_status_history(spark, sf):
    """Versions of each trade's status from all its raw rows."""
    return dims.build_scd2(fixtures.trades_raw(spark, sf), "trade_id", ["status", "currency"],
                           "updated_at")


@query
def overlapping_versions(spark, sf):
    """Quotes of one part by several suppliers, read as versions that may overlap."""
    lines = fixtures.table(spark, sf, "lineitem")
    spans = lines.select(
        F.concat(F.lit("I"), F.col("l_partkey").cast("string")).alias("instrument_id"),
        F.col("l_shipdate").cast("timestamp").alias("valid_from"),
        (F.col("l_shipdate").cast("timestamp") + F.expr("INTERVAL 60 DAYS")).alias("valid_to"))
    return dims.overlapping_versions(spans, "instrument_id")


@query
def asof_instrument(spark, sf):
    cols = ["instrument_name", "asset_class", "sector"]
    return enrich.asof_dim(_valid(spark, sf).select(*TRADE_KEY, "instrument_id", "trade_date"),
                           fixtures.dim_instruments(spark, sf), "instrument_id", "trade_date",
                           cols)


@query
def asof_instrument_carried(spark, sf):
    """The same by carrying versions along: for keys with many of them."""
    cols = ["instrument_name", "asset_class", "sector"]
    return enrich.asof_carried(_valid(spark, sf).select(*TRADE_KEY, "instrument_id", "trade_date"),
                               fixtures.dim_instruments(spark, sf), "instrument_id", "trade_date", cols)


@query
def current_instrument(spark, sf):
    return enrich.current_dim(_valid(spark, sf).select(*TRADE_KEY, "instrument_id"),
                              fixtures.dim_instruments(spark, sf), "instrument_id",
                              ["instrument_name", "sector"])


@query
def daily_pnl(spark, sf):
    return marts.build_daily_pnl(_fact(spark, sf))


@query
def daily_pnl_custom(spark, sf):
    """Settled amounts as realised PnL, cancelled trades left out."""
    settled = F.when(F.col("status") == "SETTLE", F.col("notional_usd"))
    return marts.build_daily_pnl(_fact(spark, sf), settled, exclude_status=["CANCEL"])


@query
def daily_pnl_region(spark, sf):
    return search.daily_pnl(marts.build_daily_pnl(_fact(spark, sf)), "1998-06-01", "ASIA")


@query
def daily_notional_by_class(spark, sf):
    """The flagship: dedup, checks, lookups and daily totals in one plan."""
    return (_fact(spark, sf).groupBy("trade_date", "region", "asset_class")
            .agg(F.sum("notional_usd").cast(MONEY).alias("total_notional_usd"),
                 F.count(F.lit(1)).alias("trade_count")))


@query
def load_times(spark, sf):
    """Rows of a dimension and of the daily aggregate, and how many of them bear the time of their load; one row came with its own."""
    early = F.when(F.col("is_active") & (F.col("instrument_id") == "I1"), F.lit("2020-01-01").cast("timestamp"))
    frames = {"instruments": fixtures.dim_instruments(spark, sf).withColumn("loaded_at", early), "daily_pnl": marts.build_daily_pnl(_fact(spark, sf))}
    return lake.union_evolving(*[marts.with_load_time(df).agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count("loaded_at").alias("stamped"),
        F.count_if(F.year("loaded_at") == 2020).alias("kept")) for name, df in frames.items()])


@query
def daily_pnl_table(spark, sf):
    """Daily aggregate stored by date and region, one year written again, and read back."""
    fact = _fact(spark, sf).withColumn("trade_date", F.trunc("trade_date", "year"))
    pnl = stage(marts.build_daily_pnl(fact), "pnl")
    path = scratch_path(spark, "daily-pnl")
    sinks.write_daily_pnl(pnl, path)
    sinks.write_daily_pnl(pnl.filter("report_date = date'1998-01-01'"), path, ["1998-01-01"])
    return spark.read.parquet(path).select(*pnl.columns)


# --- Layouts and upkeep ---------------------------------------------------------------------

def _yearly(spark, sf, trades=_valid):
    """Curated rows with the trade year's first day as date: few, large partitions."""
    current = enrich.current(fixtures.dim_instruments(spark, sf))
    rows = enrich.enrich_batch(trades(spark, sf), current)
    return rows.withColumn("trade_date", F.trunc("trade_date", "year")).drop(*TIES)


@query
def curated_layout(spark, sf):
    rows, path = _yearly(spark, sf), scratch_path(spark, "curated")
    sinks.write_curated(rows, path)
    return spark.read.parquet(path).select(*rows.columns)


@query
def compact_preserves_rows(spark, sf):
    """A table written by as many tasks as its input asks for, so that each date has small files of all of them."""
    rows, path = _yearly(spark, sf, _stored_trades), scratch_path(spark, "compact")
    size = maintenance.list_files(spark, f"{sf}/lineitem.parquet").agg(F.sum("length")).first()[0]
    with freed(spark):
        rows.repartition(max(6, size // COMPACT_TASK_BYTES)).write.partitionBy("trade_date", "asset_class").parquet(path)
    maintenance.compact(spark, path, "1997-01-01")
    return spark.read.parquet(path).select(*rows.columns)


@query
def expired_partitions(spark, sf):
    rows, path = _yearly(spark, sf), scratch_path(spark, "expired")
    rows.write.partitionBy("trade_date", "asset_class").parquet(path)
    return maintenance.expired_partitions(spark, path, "1998-06-30", 365).select("trade_date")


@query
def quarantine_layout(spark, sf):
    """Quarantine written twice for one run: the second write replaces the first."""
    path = scratch_path(spark, "quarantine")
    invalid = stage(quality.validate(_newest(spark, sf))[1], "invalid")
    sinks.write_quarantine(invalid, path, "1998-06-01")
    sinks.write_quarantine(invalid, path, "1998-06-01")
    return spark.read.parquet(path).groupBy("process_date", "quarantine_reason").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def sorted_layout(spark, sf):
    late, path = marts.derived_columns(), scratch_path(spark, "sorted")
    fact = sinks.moved(_whole_fact(spark, sf), lambda rows: stage(rows, "fact", PACKED), late)
    sinks.write_sorted(fact, path, ["trade_date", "asset_class", "desk"], late=late)
    return spark.read.parquet(path)


@query
def sorted_layout_bounds(spark, sf):
    """Rows of a sorted table, and how many of its files begin before the one before them ends; a third of the rows share a key."""
    path, by = scratch_path(spark, "sorted"), ["trade_date", "trade_id"]
    hot = F.col("tie_part") % 3 == 0
    rows = fixtures.trades_raw(spark, sf).withColumns({
        "trade_date": F.when(hot, F.lit("1995-06-01").cast("date")).otherwise(F.col("trade_date")),
        "trade_id": F.when(hot, "hot").otherwise(F.col("trade_id"))})
    sinks.write_sorted(rows, path, by)
    files = sinks.file_bounds(spark.read.parquet(path), by)
    before = F.lag("high").over(Window.orderBy("low", "high"))  # one row per file
    return files.withColumn("before", before).agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("before") > F.col("low")).alias("overlaps"))


@query
def bucketed_layout(spark, sf):
    """Trades per event type from a table bucketed by trade id."""
    name = f"fct_{uuid.uuid4().hex}"
    late = marts.derived_columns()
    fact = sinks.moved(_whole_fact(spark, sf), lambda rows: stage(rows, "fact", PACKED), late)
    sinks.write_bucketed(fact, name, "trade_id", 8, path=scratch_path(spark, name), late=late)
    maintenance.analyze(spark, name)
    out = stage(spark.table(name).groupBy("trade_id").agg(F.count(F.lit(1)).alias("events")), "bucketed")
    spark.sql(f"DROP TABLE {name}")
    return out


@query
def table_statistics(spark, sf):
    """What the catalog knows of a table after its statistics were computed."""
    name = f"parts_{uuid.uuid4().hex}"
    parts = fixtures.table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size")).alias("p_size"))
    sinks.write_bucketed(parts, name, "p_partkey", 4, path=scratch_path(spark, name))
    maintenance.analyze(spark, name)
    known = maintenance.statistics(spark, name, ["p_partkey", "p_size"])
    out = known.select(F.coalesce("column", F.lit("rows")).alias("about"),
                       F.when(F.col("column").isNull(), F.col("distinct")).alias("rows"), "nulls")
    spark.sql(f"DROP TABLE {name}")
    return out


@query
def union_evolving(spark, sf):
    raw = fixtures.trades_raw(spark, sf)
    old = raw.filter("trade_date < date'1998-01-01'").drop("status", *TIES)
    new = raw.filter("trade_date >= date'1998-01-01'").drop(*TIES)
    return lake.union_evolving(old, new)


@query
def replay_hours(spark, sf):
    valid = parse.split_valid(_events(spark, sf))[0]
    path = scratch_path(spark, "raw-hours")
    (streaming.events.raw_layout(valid).select(
        "trade_id", "instrument_id", "notional", "event_ts", "year", "month", "day", "hour")
     .hint("rebalance", "year", "month", "day", "hour")
     .write.partitionBy("year", "month", "day", "hour").parquet(path))
    return lake.replay(spark, path, "2024-01-05 06:30:00", "2024-01-09 17:15:00").select(
        "trade_id", "instrument_id", "notional", "event_ts")


# --- Quality -------------------------------------------------------------------------------------

@query
def dq_fct_trades(spark, sf):
    return _checked_fact(spark, sf, quality.fct_trades_checks())


@query
def dq_dim_instruments(spark, sf):
    return quality.run_suite(fixtures.dim_instruments(spark, sf),
                             quality.dim_instruments_checks())


@query
def dq_daily_pnl(spark, sf):
    return quality.run_suite(marts.build_daily_pnl(_fact(spark, sf)), quality.daily_pnl_checks())


@query
def dq_raw_trades(spark, sf):
    """The fact's checks on raw rows, where they do find failures."""
    raw = fixtures.trades_raw(spark, sf).withColumns({
        "trade_sk": keys.surrogate_key(*TRADE_KEY), "notional_usd": F.col("notional")})
    return quality.run_suite(raw, quality.fct_trades_checks())


@query
def dq_schema_constraints(spark, sf):
    checks = quality.checks_from_schema(DIM_INSTRUMENTS, "instrument_sk")
    return quality.run_suite(fixtures.dim_instruments(spark, sf), checks)


@query
def dq_fact_schema_constraints(spark, sf):
    fields = [f for f in FCT_TRADES.fields if f.name in marts.FACT_COLUMNS]
    checks = quality.checks_from_schema(type(FCT_TRADES)(fields), "trade_sk")
    return _checked_fact(spark, sf, checks)


@query
def dq_dim_schema_constraints(spark, sf):
    """Constraints of the other dimensions and of the rates."""
    fx = fixtures.dim_fx_rates(spark, sf)
    suites = {
        "traders": (fixtures.dim_traders(spark, sf), quality.checks_from_schema(DIM_TRADERS, "trader_sk")),
        "books": (fixtures.dim_books(spark, sf), quality.checks_from_schema(DIM_BOOKS, "book_sk")),
        "counterparties": (fixtures.dim_counterparties(spark, sf), quality.checks_from_schema(DIM_COUNTERPARTIES, "counterparty_sk")),
        "fx_rates": (fx, quality.checks_from_schema(DIM_FX_RATES, ["currency", "rate_date"])),
    }
    return lake.union_evolving(*[quality.run_suite(df, checks).select(F.lit(name).alias("table_name"), "test", "failures", "status")
                                 for name, (df, checks) in suites.items()])


@query
def source_freshness(spark, sf):
    """The same newest row against four moments."""
    raw = stage(fixtures.trades_raw(spark, sf).select("updated_at"), "freshness")
    newest = raw.agg(F.max("updated_at")).first()[0]
    frames = []
    for name, hours in (("a_equal_warn", 12), ("b_past_warn", 13), ("c_past_error", 25),
                        ("d_fresh", 1)):
        now = F.lit(newest) + F.make_interval(hours=F.lit(hours))
        at = spark.range(1).select(now.alias("n")).first()["n"]
        frames.append(quality.freshness(raw, "updated_at", at, 12, 24)
                      .select(F.lit(name).alias("source"), "max_loaded_at", "status"))
    return lake.union_evolving(*frames)


@query
def failed_publishes(spark, sf):
    """Messages of events that lack a mandatory key: keyed by trade, without headers."""
    dead = envelope.split_publishable(_events(spark, sf))[1].select("trade_id", "instrument_id", "notional")
    out = envelope.dead_letter_messages(dead)
    return out.select("key", "value", F.size("headers").alias("headers"))


@query
def publishable_events(spark, sf):
    """Events that may be published and dead letters, counted by mandatory keys."""
    ok, dead = envelope.split_publishable(_events(spark, sf))
    return lake.union_evolving(
        ok.agg(F.lit("publish").alias("route"), F.count(F.lit(1)).alias("rows")),
        dead.agg(F.lit("dead_letter").alias("route"), F.count(F.lit(1)).alias("rows")))


# --- Events and windows --------------------------------------------------------------------------

@query
def parse_events_valid(spark, sf):
    return parse.split_valid(_events(spark, sf))[0].select(
        "trade_id", "instrument_id", "notional", "currency", "trade_date", "event_ts",
        "updated_at", "raw")


@query
def parse_events_invalid(spark, sf):
    return parse.split_valid(_events(spark, sf))[1].select("trade_id", "reason", "raw",
                                                            "event_ts")


@query
def dead_letters(spark, sf):
    return streaming.events.dead_letters(parse.split_valid(_events(spark, sf))[1])


@query
def notional_5m(spark, sf):
    return windows.flat(windows.notional_5m(parse.split_valid(_events(spark, sf))[0]))


@query
def enrich_stream_batchwise(spark, sf):
    valid = parse.split_valid(_events(spark, sf))[0]
    return enrich.enrich_stream(
        valid, fixtures.dim_instruments(spark, sf), fixtures.dim_counterparties(spark, sf)
    ).select("trade_id", "instrument_id", "instrument_name", "asset_class",
             "counterparty_name", "notional")


@query
def keyed_envelope(spark, sf):
    valid = parse.split_valid(_events(spark, sf))[0]
    rows = valid.select("trade_id", "instrument_id", "notional", "currency", "book_id",
                        "event_ts", F.md5("trade_id").alias("correlation_id"))
    rows = rows.withColumn("event_ms", F.unix_millis("event_ts")).drop("event_ts")
    out = envelope.trade_messages(rows, "LAKE", order_by="event_ms")
    return out.select("key", "value", F.array_join(F.transform(
        "headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))), ";")
        .alias("headers"))


@query
def sequenced_envelope(spark, sf):
    """Messages of each instrument numbered in the order of their events."""
    rows = parse.split_valid(_events(spark, sf))[0].select(
        "trade_id", "instrument_id", F.unix_millis("event_ts").alias("event_ms"), F.md5("trade_id").alias("correlation_id"))
    out = envelope.trade_messages(rows, "LAKE", order_by=["event_ms", "trade_id"], sequence="sequence")
    sequence = F.filter("headers", lambda h: h["key"] == "sequence")[0]["value"].cast("string").cast("long")
    return out.select("key", F.get_json_object("value", "$.trade_id").alias("trade_id"), sequence.alias("sequence"))


# --- Reads --------------------------------------------------------------------------------------

def _searchable(spark, sf):
    return _fact(spark, sf)


@query
def search_trades(spark, sf):
    page = search.search_trades(_searchable(spark, sf), "1996-01-01", "1998-12-31",
                                asset_class="RATES", desk="DESK_3", limit=50)
    return page.drop("settlement_date")


@query
def search_trades_after_cursor(spark, sf):
    return search.search_trades(_searchable(spark, sf), "1995-01-01", "2001-12-31",
                                status="NEW", limit=1000, cursor=("2", "NEW"),
                                fields=["trade_id", "event_type", "notional_usd"])


@query
def search_connection(spark, sf):
    one = search.search_connection(_searchable(spark, sf), "1996-01-01", "1998-12-31",
                                   book_id="B3", limit=20, fields=["trade_id", "notional"])
    return one.select(
        F.array_join(F.transform("trades", lambda t: t["trade_id"]), ",").alias("trade_ids"),
        F.col("page_info.page_count").cast("bigint").alias("page_count"),
        F.col("page_info.has_next_page").alias("has_next_page"),
        F.col("page_info.next_cursor.trade_id").alias("cursor_trade_id"),
        F.col("page_info.next_cursor.event_type").alias("cursor_event_type"))


@query
def search_trades_page(spark, sf):
    return search.search_trades_page(_searchable(spark, sf), "1995-01-01", "2001-12-31",
                                     page=7, size=100, fields=["trade_id", "event_type"])


@query
def search_trades_deep_page(spark, sf):
    return search.search_trades_page(_searchable(spark, sf), "1995-01-01", "2001-12-31",
                                     page=40, size=1000, fields=["trade_id", "event_type"])


@query
def api_trade_rows(spark, sf):
    rows = search.as_trade_rows(_searchable(spark, sf), extra=["event_type"])
    return rows.withColumns({c: F.col(c).cast(MONEY) for c in ("notional", "notional_usd")})


@query
def api_instrument_rows(spark, sf):
    return search.as_instrument_rows(fixtures.dim_instruments(spark, sf))


@query
def find_trade(spark, sf):
    return search.find_trade(_searchable(spark, sf), "1000-1",
                             ["trade_id", "event_type", "status", "notional"])


@query
def find_instrument(spark, sf):
    return search.find_instrument(fixtures.dim_instruments(spark, sf), "I102")


@query
def trade_lifecycle(spark, sf):
    life = search.trade_lifecycle(_newest(spark, sf))
    return life.select("trade_id", F.array_join(F.transform(
        "events", lambda e: F.concat(F.date_format(e["updated_at"], "yyyy-MM-dd"), F.lit(":"),
                                     e["event_type"])), ",").alias("steps"))


@query
def trade_lifecycle_raw(spark, sf):
    """The history with every delivery of every step."""
    life = search.trade_lifecycle(fixtures.trades_raw(spark, sf))
    return life.select("trade_id", F.array_join(F.transform(
        "events", lambda e: F.concat(F.date_format(e["updated_at"], "yyyy-MM-dd"), F.lit(":"),
                                     e["event_type"])), ",").alias("steps"))


@query
def lifecycle_steps(spark, sf):
    return search.lifecycle_steps(fixtures.trades_raw(spark, sf))


@query
def latest_trade_state(spark, sf):
    return search.latest_state(_newest(spark, sf)).select("trade_id", "event_type", "updated_at")


@query
def recent_trades_per_instrument(spark, sf):
    return search.recent_trades(_searchable(spark, sf), "1998-12-31", days=365, limit=3).select(
        "instrument_id", "position", "trade_id", "event_type", "trade_date")


@query
def instruments_nested(spark, sf):
    nested = search.instruments_with_recent_trades(
        fixtures.dim_instruments(spark, sf), _searchable(spark, sf), "1998-12-31", days=365,
        limit=3)
    return nested.select("instrument_id", "instrument_name", "is_active", F.array_join(
        F.transform("recent_trades", lambda t: F.concat(t["trade_id"], F.lit("/"),
                                                        t["event_type"])), ",")
        .alias("recent"))


# --- Confirmations ---------------------------------------------------------------------------------

def _csv_folder(spark, sf) -> str:
    path = scratch_path(spark, "confirmations-csv")
    with freed(spark):
        fixtures.confirmation_rows(spark, sf).write.partitionBy("sender") \
            .option("header", "true").csv(path)
    return path


def _envelopes(spark, folder, fmt="CSV"):
    """An envelope per file below ``folder``, as its sender would have written it."""
    files = checksums_of(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.concat_ws("-", "sender", name).alias("file_id"),
        F.col("sender").alias("sender_duns"), F.col("sender").alias("sender_name"),
        F.lit("US").alias("receiver_duns"), F.lit("TRADE_CONFIRM").alias("file_type"),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("received_at"),
        F.col("sha256").alias("file_checksum"), F.lit(fmt).alias("file_format"),
        "path")


@query
def confirmations_csv(spark, sf):
    env = stage(_envelopes(spark, _csv_folder(spark, sf)), "envelopes")
    rows, _ = confirmations.read_all(spark, env)
    return rows.withColumn("source_file_id", F.substring_index("source_file_id", "-", 1))


@query
def confirmations_mapped_csv(spark, sf):
    """Each sender's files under a header of its own, read in one pass."""
    path = scratch_path(spark, "confirmations-mapped")
    rows = fixtures.confirmation_rows(spark, sf).select(
        F.col("NOTIONAL").alias("Amount"), F.col("TRADE_ID").alias("Their Id"),
        F.col("OUR_REF"), F.col("CURRENCY").alias("Ccy"), F.col("sender"))
    rows.write.partitionBy("sender").option("header", "true").csv(path)
    env = stage(_envelopes(spark, path), "envelopes")
    standard = {"trade_id": "Their Id", "notional": "Amount", "currency": "Ccy"}
    mapping = env.select("sender_duns").distinct().select("sender_duns", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(n).alias("source_name"))
        for c, n in standard.items()])))
    rows, _ = confirmations.read_all(spark, env, mapping)
    return rows.select("trade_id", "our_ref", "notional", "currency", "price", "direction",
                       "error")


def _fpml_folder(spark, sf, odd: bool = False) -> str:
    """One document per sender and year; some senders use a namespace prefix.

    ``odd`` adds what looks like tags of a trade and is none, an empty trade per document, and
    a document per sender that is not well-formed.
    """
    rows = fixtures.confirmation_rows(spark, sf).withColumn("year", F.substring("TRADE_DATE", 1, 4))
    prefixed = F.substring("sender", -1, 1).isin("1", "3", "5", "7", "9")
    p = F.when(prefixed, "f:").otherwise("")

    def tag(name, content, attrs=""):
        return F.concat(F.lit("<"), p, F.lit(name + attrs + ">"), content,
                        F.lit("</"), p, F.lit(name + ">"))

    looks = tag("subtrade", F.concat(F.lit("<![CDATA[</trade>]]><!-- </"), p, F.lit("trade> <trade> -->")), " note='a>b'")
    extra = F.when(F.col("TRADE_DATE").endswith("3"), looks).otherwise("") if odd else F.lit("")
    trade = tag("trade", F.concat(
        extra, tag("tradeHeader", F.concat(
            tag("partyTradeIdentifier", F.concat(
                tag("tradeId", F.col("TRADE_ID")),
                tag("tradeId", F.col("OUR_REF"), ' partyReference="party1"'))),
            tag("tradeDate", F.col("TRADE_DATE")))),
        tag("product", F.concat(
            F.lit("<"), p, F.lit('buyerPartyReference href="'), F.col("DIRECTION"), F.lit('"/>'),
            tag("instrumentId", F.col("ISIN")),
            tag("leg", tag("notionalAmount", F.concat(
                tag("currency", F.col("CURRENCY")), tag("amount", F.col("NOTIONAL"))))),
            tag("initialPrice", tag("cleanPrice", F.col("PRICE"))),
            tag("settlementDate", F.col("SETTLEMENT_DATE")))),
        tag("party", tag("partyId", F.col("LEI"),
                         ' partyIdScheme="http://www.gleif.org/data/schema/leiData"'))))
    docs = stage(rows.select("sender", "year").distinct(), "documents")
    xmlns = F.when(prefixed, "xmlns:f=").otherwise("xmlns=")
    head = F.concat(
        F.lit('<?xml version="1.0"?>\n<'), p, F.lit("dataDocument "), xmlns,
        F.lit('"http://www.fpml.org/FpML-5/confirmation">'),
        F.lit("<!-- <trade> --><?note </trade>?>" if odd else ""))
    empty = F.concat(F.lit("<"), p, F.lit("trade/>")) if odd else F.lit("")
    tail = F.concat(empty, F.lit("</"), p, F.lit("dataDocument>"))
    ends = docs.select("sender", "year", F.explode(F.array(F.lit(0), F.lit(2))).alias("ord"))
    if odd:
        ends = ends.union(docs.select("sender").distinct().select("sender", F.lit("broken"), F.lit(3)))
    value = (F.when(F.col("ord") == 0, head).when(F.col("ord") == 1, trade).when(F.col("ord") == 2, tail)
             .otherwise("<dataDocument><trade/><trade><swap></trade></dataDocument>"))
    path = scratch_path(spark, "confirmations-fpml")
    # the fields are moved, not the many times larger text; a document is one task's to write, so nothing is lost by gzip
    with freed(spark):
        (rows.withColumn("ord", F.lit(1)).unionByName(ends, allowMissingColumns=True).repartition("sender", "year")
         .sortWithinPartitions("sender", "year", "ord").select("sender", "year", value.alias("value"))
         .write.partitionBy("sender", "year").text(path, compression="gzip"))
    return path


@query
def confirmations_fpml(spark, sf):
    env = stage(_envelopes(spark, _fpml_folder(spark, sf), "FPML"), "envelopes")
    rows, _ = confirmations.read_all(spark, env)
    return rows.withColumn("source_file_id", F.substring_index("source_file_id", "-", 1))


@query
def confirmations_fpml_odd(spark, sf):
    """Documents with comments, CDATA, instructions and other elements that look like trades; the reason of rejected ones."""
    env = stage(_envelopes(spark, _fpml_folder(spark, sf, odd=True), "FPML"), "envelopes")
    rows, rejects = confirmations.read_all(spark, env)
    both = rows.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.select(F.col("file_id").alias("source_file_id"), "reason"), allowMissingColumns=True)
    return both.withColumn("source_file_id", F.substring_index("source_file_id", "-", 1))


@query
def confirmations_csv_multiline(spark, sf):
    """One file per sender, in which quoted fields hold commas, quotes and line breaks."""
    rows = fixtures.confirmation_rows(spark, sf)
    names = [c for c in rows.columns if c != "sender"]
    noted = F.when(F.col("TRADE_DATE").endswith("3"), F.concat(F.lit('"'), "DIRECTION", F.lit(',\n""side""\n"')))
    lines = rows.select("sender", F.lit(1).alias("ord"), F.concat_ws(
        ",", *[noted.otherwise(F.col(c)) if c == "DIRECTION" else F.col(c) for c in names]).alias("value"))
    head = rows.select("sender").distinct().select("sender", F.lit(0).alias("ord"), F.lit(",".join(names)).alias("value"))
    path = scratch_path(spark, "confirmations-multiline")
    with freed(spark):
        (lines.union(head).repartition("sender").sortWithinPartitions("sender", "ord").drop("ord")
         .write.partitionBy("sender").text(path))
    env = stage(_envelopes(spark, path), "envelopes")
    rows, _ = confirmations.read_all(spark, env)
    return rows.withColumn("source_file_id", F.substring_index("source_file_id", "-", 1))


@query
def new_files(spark, sf):
    """Arrivals of customer files, each order once: known customers and repeats are skipped."""
    orders = fixtures.table(spark, sf, "orders")
    arrivals = orders.select(
        F.concat(F.lit("F"), F.col("o_custkey").cast("string")).alias("file_id"),
        F.col("o_orderdate").cast("timestamp").alias("received_at"),
        F.col("o_orderkey").cast("string").alias("path"))
    ledger = fixtures.table(spark, sf, "customer").select(
        F.concat(F.lit("F"), F.col("c_custkey").cast("string")).alias("file_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "COMPLETED").otherwise("RECEIVED")
        .alias("state"))
    fresh, repeated = confirmations.new_files(arrivals, ledger)
    return lake.union_evolving(
        fresh.withColumns({"outcome": F.lit("NEW"), "copies": F.lit(1).cast("bigint")}),
        repeated.withColumn("outcome", F.lit("DUPLICATE")))


def _intake(spark, sf):
    """CSV files of all senders; one has a wrong checksum, two a format we cannot read."""
    env = _envelopes(spark, _csv_folder(spark, sf))
    sender = F.col("sender_duns")
    return stage(env.withColumns({
        "file_checksum": F.when(sender == "B0", "00").otherwise(F.col("file_checksum")),
        "file_format": F.when(sender == "B1", "MT518").when(sender == "B2", "FIX")
        .otherwise(F.col("file_format")),
    }), "envelopes")


@query
def checksums(spark, sf):
    env = _intake(spark, sf)
    sound, wrong = confirmations.verify_checksums(confirmations.read_files(spark, env), env)
    sender = F.substring_index("file_id", "-", 1).alias("sender")
    return lake.union_evolving(
        sound.select(sender, F.lit("SOUND").alias("outcome")),
        wrong.select(sender, F.col("reason").alias("outcome"))).distinct()


@query
def confirmation_ledger(spark, sf):
    """The ledger after two runs over the same files: the second finds them all done."""
    env = stage(_envelopes(spark, _csv_folder(spark, sf)), "envelopes")
    ledger = scratch_path(spark, "ledger")
    for _ in range(2):
        jobs.run_confirmations(spark, env, ledger, scratch_path(spark, "messages"), "GATEWAY", at="2024-01-02 00:00:00").collect()
    rows = spark.read.parquet(ledger)
    once = rows.groupBy("file_id", "state").agg(F.count(F.lit(1)).alias("entries"), F.sum("processed").alias("processed"), F.sum("failed").alias("failed"))
    return once.groupBy(F.substring_index("file_id", "-", 1).alias("sender"), "state").agg(
        F.max("entries").alias("entries"), F.sum("processed").alias("processed"), F.sum("failed").alias("failed"))


@query
def file_outcomes(spark, sf):
    env = _intake(spark, sf)
    sound, wrong = confirmations.verify_checksums(confirmations.read_files(spark, env), env)
    rows, unread = confirmations.read_all(spark, sound)
    out = confirmations.file_outcomes(env, rows, wrong.unionByName(unread))
    return out.groupBy(F.substring_index("file_id", "-", 1).alias("sender")).agg(
        F.max("status").alias("status"), F.sum("processed").alias("processed"),
        F.sum("failed").alias("failed"), F.max("reason").alias("reason"))


def _confirms(spark, sf):
    """Confirmations with breaks: by due date the amount is off, the currency another, or the price."""
    rows = fixtures.confirmation_rows(spark, sf)
    settles = F.dayofmonth(F.col("SETTLEMENT_DATE").cast("date"))
    amount = F.col("NOTIONAL").try_cast(MONEY)
    return rows.select(
        F.col("TRADE_ID").alias("trade_id"),
        F.when(settles == 1, "").when(settles == 2, F.concat(F.lit("X"), "OUR_REF"))
        .otherwise(F.col("OUR_REF")).alias("our_ref"),
        F.when(settles == 3, (amount + 1).cast(MONEY)).otherwise(amount).alias("notional"),
        F.when(settles == 4, "CHF").otherwise(F.nullif("CURRENCY", F.lit(""))).alias("currency"),
        F.when(settles == 5, F.lit("1.6")).otherwise(F.col("PRICE")).try_cast(MONEY).alias("price"))


@query
def reconcile_confirmations(spark, sf):
    trades = _newest(spark, sf).drop(*TIES).withColumn("price", F.lit("1.5").cast(MONEY))
    return confirmations.reconcile(_confirms(spark, sf), trades, ties=[])  # one state per trade and event type


@query
def confirmation_messages(spark, sf):
    env = stage(_envelopes(spark, _csv_folder(spark, sf)), "envelopes")
    rows, _ = confirmations.read_all(spark, env)
    good = rows.filter(F.col("error").isNull())
    messages = confirmations.to_messages(good, env, "FILE_GATEWAY")
    header = F.transform("headers", lambda h: F.concat(
        h["key"], F.lit("="), F.substring_index(h["value"].cast("string"), "-", 1)))
    return messages.select("key", F.get_json_object("value", "$.our_ref").alias("our_ref"),
                           F.get_json_object("value", "$.currency").alias("currency"),
                           F.array_join(header, ";").alias("headers"))


# --- Streams ------------------------------------------------------------------------------------------

def _event_files(spark, sf) -> str:
    return fixtures.write_scratch_text(
        fixtures.trade_events_json(spark, sf).select("value"), "events")


def _stream(spark, folder):
    return parse.split_valid(parse.parse_events(
        lake.read_event_stream(spark, "text", folder)))


@query
def stream_notional_5m(spark, sf):
    """The window aggregate as a stream: windows closed by the watermark."""
    out = scratch_path(spark, "stream-windows")
    valid, _ = _stream(spark, _event_files(spark, sf))
    streaming.write_metrics(streaming.windowed_notional(valid), out,
                            scratch_path(spark, "ckpt"), AVAILABLE).awaitTermination()
    return spark.read.parquet(out)


@query
def stream_start_all(spark, sf):
    """Dead letters, raw landing and windows of one stream, counted per output."""
    folder = _event_files(spark, sf)
    paths = {n: scratch_path(spark, f"stream-{n}") for n in ("dead_letters", "raw", "metrics")}
    running = streaming.start_all(
        lake.read_event_stream(spark, "text", folder), fixtures.dim_instruments(spark, sf),
        fixtures.dim_counterparties(spark, sf), paths, scratch_path(spark, "ckpt"), AVAILABLE)
    for q in running:
        q.awaitTermination()
    dead = spark.read.schema("key string, value string").json(paths["dead_letters"])
    raw, metrics = spark.read.parquet(paths["raw"]), spark.read.parquet(paths["metrics"])
    return lake.union_evolving(
        dead.agg(F.lit("dead_letters").alias("output"), F.count(F.lit(1)).alias("rows"),
                 F.lit(None).cast(MONEY).alias("notional")),
        raw.agg(F.lit("raw").alias("output"), F.count(F.lit(1)).alias("rows"),
                F.sum("notional").cast(MONEY).alias("notional")),
        metrics.agg(F.lit("metrics").alias("output"), F.sum("trade_count").alias("rows"),
                    F.sum("total_notional").cast(MONEY).alias("notional")))


@query
def stream_late_data(spark, sf):
    """All events sent again after their windows closed: raw keeps them, windows do not."""
    folder, raw = _event_files(spark, sf), scratch_path(spark, "stream-raw")
    out = scratch_path(spark, "stream-windows")
    c_raw, c_win = scratch_path(spark, "ckpt"), scratch_path(spark, "ckpt")

    def drain():
        valid, _ = _stream(spark, folder)
        a = streaming.write_raw(valid, raw, c_raw, AVAILABLE)
        b = streaming.write_metrics(streaming.windowed_notional(valid), out, c_win, AVAILABLE)
        a.awaitTermination()
        b.awaitTermination()

    drain()
    again = fixtures.trade_events_json(spark, sf).select("value")
    again.write.mode("append").text(folder)
    drain()
    return lake.union_evolving(
        spark.read.parquet(raw).agg(F.lit("raw").alias("output"),
                                    F.count(F.lit(1)).alias("rows")),
        spark.read.parquet(out).agg(F.lit("windows").alias("output"),
                                    F.sum("trade_count").alias("rows")))


@query
def stream_late_rows(spark, sf):
    """What the watermark drops over more than a hundred micro-batches: all events, after two from long after them."""
    folder, batches = scratch_path(spark, "stream-late"), 104
    events = fixtures.trade_events_json(spark, sf)
    for n in range(2):  # the second batch is the first to know of the watermark, the third to drop by it
        late = F.lit('{"tradeId":"L","instrumentId":"L","notional":1,"currency":"USD","eventTimestamp":4102444800000}')
        spark.range(1).select(late.alias("value")).coalesce(1).write.mode("append").text(f"{folder}/part=first{n}")
    number = F.substring(F.get_json_object("value", "$.tradeId"), 2, 20).cast("long")
    (events.select("value", F.coalesce(number % batches, F.lit(0)).alias("part")).repartition(batches, "part")
     .write.mode("append").partitionBy("part").text(folder))
    seen = streaming.LateRows(spark, scratch_path(spark, "late"))
    spark.streams.addListener(seen)
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # the state of a hundred small batches
    try:
        stream = lake.read_event_stream(spark, "text", folder, {"maxFilesPerTrigger": "1", "recursiveFileLookup": "true"})
        valid = parse.split_valid(parse.parse_events(stream))[0]
        q = streaming.write_metrics(streaming.windowed_notional(valid), scratch_path(spark, "win"), scratch_path(spark, "ckpt"), AVAILABLE)
        q.awaitTermination()
        seen.wait(q)
    finally:
        spark.streams.removeListener(seen)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    return seen.totals().select("dropped")


@query
def stream_upsert(spark, sf):
    """The newest event per instrument, kept in a table by a stream."""
    path = scratch_path(spark, "stream-table")
    valid, _ = _stream(spark, _event_files(spark, sf))
    rows = valid.select(F.col("instrument_id").alias("trade_id"), F.lit("NEW").alias("event_type"),
                        "notional", "currency", "updated_at")
    streaming.upsert_to_table(rows, path, scratch_path(spark, "ckpt"), AVAILABLE,
                              partitions=["currency"]).awaitTermination()
    return spark.read.parquet(path).select("trade_id", "event_type", "notional", "currency",
                                           "updated_at")


@query
def stream_redelivery(spark, sf):
    """Every event delivered twice, counted once."""
    folder, out = _event_files(spark, sf), scratch_path(spark, "stream-once")
    fixtures.trade_events_json(spark, sf).select("value").write.mode("append").text(folder)
    valid, _ = _stream(spark, folder)
    once = streaming.drop_redelivered(valid, keys=("trade_id", "event_ts"))
    (once.select("trade_id", "instrument_id", "notional", "event_ts").writeStream
     .format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "ckpt"))
     .trigger(**AVAILABLE).start().awaitTermination())
    return spark.read.parquet(out)
