"""Event-time windows, the same function for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.schemas import MONEY


def notional_5m(df: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Notional and count per instrument and tumbling window [start, end)."""
    return (
        df.groupBy(F.window("event_ts", size), "instrument_id")
        .agg(F.sum("notional").cast(MONEY).alias("total_notional"),
             F.count(F.lit(1)).alias("trade_count"))
    )


def flat(df: DataFrame) -> DataFrame:
    """Window bounds as plain columns."""
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"),
                     "instrument_id", "total_notional", "trade_count")
