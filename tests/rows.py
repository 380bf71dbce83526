"""Small trade rows for tests."""

import datetime as dt
from decimal import Decimal

from tradelake.schemas import TRADES_RAW


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def trade(trade_id="T1", event_type="NEW", at=ts(1), **over):
    row = {
        "trade_id": trade_id, "event_type": event_type, "instrument_id": "I1",
        "notional": Decimal("10.0000"), "currency": "USD", "trade_date": dt.date(2024, 1, 1),
        "settlement_date": dt.date(2024, 1, 3), "trader_id": "D1", "book_id": "B1",
        "counterparty_lei": "L1", "status": "NEW", "created_at": ts(1), "updated_at": at,
    }
    row.update(over)
    return tuple(row[f] for f in TRADES_RAW.fieldNames())


def trades(spark, *rows):
    return spark.createDataFrame(list(rows), TRADES_RAW)
