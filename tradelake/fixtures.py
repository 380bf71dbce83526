"""Trade-domain views over the test tables (see FIXTURES.md, section 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradelake.functions.keys import surrogate_key
from tradelake.schemas import MONEY, RATE
from tradelake.session import scratch_path


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is looked up once, not for every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _currency_of(region) -> F.Column:
    return (F.when(region == "AMERICA", "USD").when(region == "EUROPE", "EUR")
            .when(region == "ASIA", "JPY").when(region == "AFRICA", "ZAR").otherwise("AED"))


def _orders_with_region(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(places, customer.c_nationkey == places.n_nationkey))


def trades_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw trade event per line item, with missing and bad values by quantity."""
    q = F.col("l_quantity")
    event = (F.when(F.col("l_returnflag") == "N", "NEW").when(F.col("l_returnflag") == "A", "AMEND")
             .when(F.col("l_linestatus") == "O", "CANCEL").otherwise("SETTLE"))
    lines = table(spark, sf_dir, "lineitem")
    # both sides grow with the data: always join them by a shuffle, never by a broadcast
    joined = lines.join(_orders_with_region(spark, sf_dir).hint("shuffle_merge"),
                        F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("trade_id"),
        event.alias("event_type"),
        # quantity 7: an instrument nobody knows; quantity 8: a currency without rates
        F.concat(F.when(q == 7, "X").otherwise("I"), F.col("l_partkey").cast("string")).alias("instrument_id"),
        F.when(q == 1, F.lit(0).cast(MONEY)).when(q == 2, F.lit(None).cast(MONEY))
        .otherwise(F.col("l_extendedprice").cast(MONEY)).alias("notional"),
        F.when(q == 3, F.lit(None).cast("string")).when(q == 4, "usd").when(q == 8, "CHF")
        .otherwise(_currency_of(F.col("r_name"))).alias("currency"),
        F.to_date("o_orderdate").alias("trade_date"),
        F.to_date("l_shipdate").alias("settlement_date"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("trader_id"),
        F.concat(F.lit("B"), F.col("c_nationkey").cast("string")).alias("book_id"),
        F.concat(F.lit("LEI"), F.lpad(F.col("o_custkey").cast("string"), 17, "0"))
        .alias("counterparty_lei"),
        F.when(q == 5, F.lit(None).cast("string")).when(q == 6, "PENDING").otherwise(event)
        .alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        F.col("l_partkey").alias("tie_part"), F.col("l_suppkey").alias("tie_supp"),
    )


def instrument_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of the instrument master: first state, a repeat of it, and for every
    second part a new sector from 1998-06-01."""
    part = table(spark, sf_dir, "part")
    kind = F.col("p_type")
    asset_class = (F.when(kind == "ECONOMY", "EQUITY").when(kind == "SMALL", "FX")
                   .when(kind == "MEDIUM", "RATES").when(kind == "LARGE", "CREDIT")
                   .when(kind == "STANDARD", "COMMODITY").otherwise("OTHER"))
    split = F.col("p_partkey") % 2 == 0
    first = F.when(split, F.concat("p_brand", F.lit("-v1"))).otherwise(F.col("p_brand"))

    def state(sector, day):
        return F.struct(sector.alias("sector"),
                        F.lit(day).cast("timestamp").alias("changed_at"))

    states = F.array(state(first, "1995-01-01"), state(first, "1996-03-01"))
    states = F.when(split, F.concat(states, F.array(state(F.col("p_brand"), "1998-06-01")))) \
        .otherwise(states)
    return part.select(
        F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("instrument_id"),
        F.col("p_name").alias("instrument_name"), asset_class.alias("asset_class"),
        F.lit("USD").alias("currency"), F.inline(states))


def dim_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instrument dimension as it would lie in a table: versions already built."""
    changes = instrument_changes(spark, sf_dir)
    split = F.col("instrument_id").substr(F.lit(2), F.length("instrument_id")).cast("bigint") % 2 == 0
    day = F.lit("1998-06-01").cast("timestamp")
    old = split & (F.col("changed_at") < day)
    return changes.filter(F.col("changed_at") != F.lit("1996-03-01").cast("timestamp")).select(
        surrogate_key("instrument_id", "changed_at").alias("instrument_sk"),
        "instrument_id", "instrument_name", F.lit(None).cast("string").alias("isin"),
        "asset_class", "sector", F.lit(None).cast("string").alias("issuer"), "currency",
        (~old).alias("is_active"), F.col("changed_at").alias("valid_from"),
        F.when(old, day).alias("valid_to"))


def _places(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def dim_traders(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    places = _places(spark, sf_dir)
    trader = F.concat(F.lit("T"), F.col("s_suppkey").cast("string"))
    return supplier.join(places, supplier.s_nationkey == places.n_nationkey).select(
        surrogate_key(trader).alias("trader_sk"), trader.alias("trader_id"),
        F.col("s_name").alias("trader_name"),
        F.concat(F.lit("DESK_"), (F.col("s_suppkey") % 8).cast("string")).alias("desk"),
        F.col("r_name").alias("region"), F.lit(None).cast("string").alias("cost_centre"),
        F.lit(True).alias("is_active"),
        F.lit("1995-01-01").cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"))


def dim_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = F.concat(F.lit("B"), F.col("n_nationkey").cast("string"))
    return _places(spark, sf_dir).select(
        surrogate_key(book).alias("book_sk"), book.alias("book_id"),
        F.col("n_name").alias("book_name"), F.col("r_name").alias("region"),
        F.concat(F.lit("LE_"), F.col("r_regionkey").cast("string")).alias("legal_entity"))


def dim_counterparties(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, places = table(spark, sf_dir, "customer"), _places(spark, sf_dir)
    balance = F.col("c_acctbal")
    lei = F.concat(F.lit("LEI"), F.lpad(F.col("c_custkey").cast("string"), 17, "0"))
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        surrogate_key(lei).alias("counterparty_sk"), lei.alias("lei_code"),
        F.col("c_name").alias("counterparty_name"),
        F.when(balance < 0, "C").when(balance < 3000, "B").when(balance < 6000, "A")
        .otherwise("AA").alias("credit_rating"),
        F.col("n_name").alias("country"))


def dim_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate per currency and trading day."""
    days = (_orders_with_region(spark, sf_dir)
            .select(_currency_of(F.col("r_name")).alias("currency"),
                    F.to_date("o_orderdate").alias("rate_date")).distinct())
    cur = F.col("currency")
    base = (F.when(cur == "USD", F.lit("1")).when(cur == "EUR", F.lit("1.1"))
            .when(cur == "JPY", F.lit("0.007")).when(cur == "ZAR", F.lit("0.055"))
            .otherwise(F.lit("0.2723"))).cast("decimal(8,4)")
    step = (F.lit(1000) + F.dayofmonth("rate_date") % 10) * F.lit("0.001").cast("decimal(4,3)")
    return days.select("currency", "rate_date", (base * step).cast(RATE).alias("usd_rate"))


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "instruments": dim_instruments(spark, sf_dir),
        "traders": dim_traders(spark, sf_dir),
        "books": dim_books(spark, sf_dir),
        "counterparties": dim_counterparties(spark, sf_dir),
    }


def trade_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, _record_ts): events as JSON text, some malformed, some lacking fields; of three events one has a
    known counterparty, one an unknown one and one none."""
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    trade_id = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    user, kind = F.col("user_id").cast("string"), F.col("event_id") % 3
    lei = F.when(kind == 1, F.concat(F.lit("LEI"), F.lpad(user, 17, "0"))).when(kind == 2, F.concat(F.lit("LEI9"), F.lpad(user, 16, "0")))
    full = F.to_json(F.struct(
        trade_id.alias("tradeId"),
        F.concat(F.lit("I"), F.col("user_id").cast("string")).alias("instrumentId"),
        F.col("value").cast(MONEY).alias("notional"),
        F.lit("USD").alias("currency"),
        F.unix_millis("ts").alias("eventTimestamp"),
        lei.alias("counterpartyLei")))
    value = (F.when(F.col("event_id") % 97 == 0, F.lit("{bad"))
             .when(F.col("event_id") % 89 == 0, F.to_json(F.struct(trade_id.alias("tradeId"))))
             .otherwise(full))
    return ev.select(value.alias("value"), F.col("ts").alias("_record_ts"))


def confirmation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What counterparties would confirm for the trades: reference, amounts and dates."""
    t = trades_raw(spark, sf_dir)
    return t.select(
        F.concat(F.lit("C"), "trade_id", F.lit("-"), "tie_part", F.lit("-"), "tie_supp")
        .alias("TRADE_ID"),
        F.col("trade_id").alias("OUR_REF"),
        F.concat(F.lit("IS"), F.col("tie_part")).alias("ISIN"),
        F.coalesce(F.col("notional").cast("string"), F.lit("n/a")).alias("NOTIONAL"),
        F.coalesce("currency", F.lit("")).alias("CURRENCY"),
        F.col("trade_date").cast("string").alias("TRADE_DATE"),
        F.col("settlement_date").cast("string").alias("SETTLEMENT_DATE"),
        F.col("counterparty_lei").alias("LEI"),
        F.lit("1.5").alias("PRICE"),
        F.when(F.col("event_type") == "NEW", "BUY").otherwise("SELL").alias("DIRECTION"),
        F.col("book_id").alias("sender"),
    )


def write_scratch_text(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.text(path)
    return path
