"""Record layouts, rename maps and fixed values, kept in one place."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(20, 4)
RATE = T.DecimalType(12, 6)


def _field(name, dtype, nullable=True, length=None):
    return T.StructField(name, dtype, nullable, {"length": length} if length else None)


def _text(name, length, nullable=True):
    return _field(name, T.StringType(), nullable, length)


# --- Fixed values: these must equal the source systems' own lists -------------
LIFECYCLE = ["NEW", "AMEND", "CANCEL", "SETTLE"]
ASSET_CLASSES = ["EQUITY", "FX", "RATES", "CREDIT", "COMMODITY"]
CURRENCY_PATTERN = "^[A-Z]{3}$"
REQUIRED_EVENT_FIELDS = ["tradeId", "instrumentId", "notional", "currency", "eventTimestamp"]
QUARANTINE_REASON = "FAILED_DQ_CHECK"
NULL_KEY_REASON = "NULL_MERGE_KEY"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
FACT_DATE_FLOOR = "2020-01-01"
CURATED_HOURS, REFERENCE_HOURS = (12, 24), (48, 96)  # age at which a table's newest row is a warning, an error
FILE_FORMATS = ["FPML", "MT518", "CSV"]
FPML_LEI_SCHEME = "http://www.gleif.org/data/schema/leiData"
FPML_TRADE = "trade"
# Where each field lies in a trade element, prefixes taken off; the one that is an attribute; values of absent fields
FPML_PATHS = {
    "trade_id": "tradeHeader/partyTradeIdentifier/tradeId",
    "our_ref": "tradeHeader/partyTradeIdentifier/tradeId[@partyReference='party1']",
    "instrument_isin": ".//instrumentId",
    "notional": ".//notionalAmount/amount",
    "currency": ".//notionalAmount/currency",
    "trade_date": "tradeHeader/tradeDate",
    "settlement_date": ".//settlementDate",
    "counterparty_lei": f".//partyId[@partyIdScheme='{FPML_LEI_SCHEME}']",
    "price": ".//initialPrice/cleanPrice",
    "direction": ".//buyerPartyReference",
}
FPML_HREF = "direction"
FPML_DEFAULTS = {"notional": "0", "price": "0", "direction": "BUY"}

TRADE_KEY = ["trade_id", "event_type"]
CURATED_PARTITIONS = ["trade_date", "asset_class"]

# --- Dialects of the trade record ---------------------------------------------
# camelCase event field -> column
EVENT_COLUMNS = {
    "tradeId": "trade_id",
    "eventType": "event_type",
    "instrumentId": "instrument_id",
    "notional": "notional",
    "currency": "currency",
    "tradeDate": "trade_date",
    "settlementDate": "settlement_date",
    "traderId": "trader_id",
    "bookId": "book_id",
    "counterpartyLei": "counterparty_lei",
    "status": "status",
}

# CSV header -> confirmation column
CONFIRMATION_CSV = {
    "TRADE_ID": "trade_id",
    "OUR_REF": "our_ref",
    "ISIN": "instrument_isin",
    "NOTIONAL": "notional",
    "CURRENCY": "currency",
    "TRADE_DATE": "trade_date",
    "SETTLEMENT_DATE": "settlement_date",
    "LEI": "counterparty_lei",
    "PRICE": "price",
    "DIRECTION": "direction",
}

TRADES_RAW = T.StructType([
    _text("trade_id", 100),
    _text("event_type", 50),
    _text("instrument_id", 50),
    _field("notional", MONEY),
    _text("currency", 3),
    _field("trade_date", T.DateType()),
    _field("settlement_date", T.DateType()),
    _text("trader_id", 50),
    _text("book_id", 50),
    _text("counterparty_lei", 20),
    _text("status", 50),
    _field("created_at", T.TimestampType()),
    _field("updated_at", T.TimestampType()),
])

CURATED_TRADES = T.StructType(TRADES_RAW.fields + [
    _text("asset_class", 50),
    _text("instrument_name", 200),
    _text("sector", 100),
])

DIM_INSTRUMENTS = T.StructType([
    _text("instrument_sk", None, False),
    _text("instrument_id", 50, False),
    _text("instrument_name", 200, False),
    _text("isin", 12),
    _text("asset_class", 50, False),
    _text("sector", 100),
    _text("issuer", 200),
    _text("currency", 3, False),
    _field("is_active", T.BooleanType()),
    _field("valid_from", T.TimestampType(), False),
    _field("valid_to", T.TimestampType()),
])

DIM_TRADERS = T.StructType([
    _text("trader_sk", None, False),
    _text("trader_id", 50, False),
    _text("trader_name", 200, False),
    _text("desk", 100),
    _text("region", 50),
    _text("cost_centre", 50),
    _field("is_active", T.BooleanType()),
    _field("valid_from", T.TimestampType(), False),
    _field("valid_to", T.TimestampType()),
])

DIM_BOOKS = T.StructType([
    _text("book_sk", None, False),
    _text("book_id", 50, False),
    _text("book_name", 200),
    _text("region", 50),
    _text("legal_entity", 100),
])

DIM_COUNTERPARTIES = T.StructType([
    _text("counterparty_sk", None, False),
    _text("lei_code", 20, False),
    _text("counterparty_name", 200),
    _text("credit_rating", 10),
    _text("country", 50),
])

DIM_FX_RATES = T.StructType([
    _text("currency", 3, False),
    _field("rate_date", T.DateType(), False),
    _field("usd_rate", RATE),
])

FCT_TRADES = T.StructType([
    _text("trade_sk", None, False),
    _text("trade_id", 100, False),
    _text("event_type", 50, False),
    _text("instrument_id", 50),
    _text("instrument_name", 200),
    _text("asset_class", 50),
    _text("sector", 100),
    _field("notional", MONEY),
    _text("currency", 3),
    _field("usd_rate", RATE),
    _field("notional_usd", MONEY),
    _field("trade_date", T.DateType(), False),
    _field("settlement_date", T.DateType()),
    _text("trader_id", 50),
    _text("trader_name", 200),
    _text("desk", 100),
    _text("book_id", 50),
    _text("book_name", 200),
    _text("region", 50),
    _text("counterparty_lei", 20),
    _text("counterparty_name", 200),
    _text("credit_rating", 10),
    _text("status", 50),
    _field("created_at", T.TimestampType()),
    _field("updated_at", T.TimestampType()),
    _field("dbt_loaded_at", T.TimestampType()),
    _text("dbt_invocation_id", 100),
])

DAILY_PNL = T.StructType([
    _field("report_date", T.DateType(), False),
    _text("book_id", 50, False),
    _text("book_name", 200),
    _text("region", 50),
    _text("asset_class", 50),
    _field("total_notional_usd", MONEY),
    _field("trade_count", T.LongType()),
    _field("realized_pnl_usd", MONEY),
])

ENVELOPE = T.StructType([
    _text("file_id", None, False),
    _text("sender_duns", None),
    _text("sender_name", None),
    _text("receiver_duns", None),
    _text("file_type", None),
    _field("received_at", T.TimestampType()),
    _text("file_checksum", None),
    _text("file_format", None),
    _text("path", None),
])

CONFIRMATION = T.StructType([
    _text("trade_id", None),
    _text("our_ref", None),
    _text("instrument_isin", None),
    _field("notional", MONEY),
    _text("currency", None),
    _text("trade_date", None),
    _text("settlement_date", None),
    _text("counterparty_lei", None),
    _field("price", MONEY),
    _text("direction", None),
    _text("source_file_id", None),
])

LEDGER = T.StructType([
    _text("file_id", None, False),
    _text("state", None),
    _field("processed", T.LongType()),
    _field("failed", T.LongType()),
    _field("at", T.TimestampType()),
])

# API rows
TRADE_ROW = [
    "trade_id", "instrument_id", "instrument_name", "asset_class", "notional", "notional_usd",
    "currency", "trade_date", "settlement_date", "trader_id", "desk", "book_id",
    "counterparty_name", "credit_rating", "status",
]
INSTRUMENT_ROW = [
    "instrument_id", "instrument_name", "asset_class", "sector", "currency", "is_active",
]
